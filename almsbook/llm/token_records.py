"""Token ids as length-delimited binary records with a separate offset index.

A record is, in little-endian order::

    uint64 size | uint32 masked crc of size | payload | uint32 masked crc of payload | line feed
    payload: uint8 flags (1: four-byte ids, 2: no document id) | int64 document id | the ids

A masked checksum is crc32 rotated right by 15 bits plus a constant, so that a checksum of data that
holds checksums stays sound. Records stand in ascending order of document id over the files
``part-00000…``, and Spark's own file sink writes them: it commits whole tasks, so a lost executor leaves
neither half files nor repeated ones, and any file system that Spark knows will do. The line feed is what
that sink ends a row with; readers go by the sizes. The index, a Parquet table beside the files, has the
file, offset and size of every record, for reads in any order.

Defined results: a null text is an empty one and has only the end id; rows without an id come first;
repeated rows are records each; an empty table gives no records; other columns are not looked at.
"""

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice, pairwise
from unicodedata import category

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from almsbook.llm.common import id_and_text, to_batch, worker_state
from almsbook.sources.storage import materialize, scratch_path

WIDE, NAMELESS = 1, 2
HEAD, SUM = struct.Struct("<QI"), struct.Struct("<I")
SIZE, LEAD = struct.Struct("<Q"), struct.Struct("<Bq")
INDEX = pa.schema([
    ("file", pa.string()), ("place", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()), ("doc_id", pa.int64())
])
DIGEST = pa.schema([
    ("file", pa.string()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())
])
RECORDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """One record without its line feed."""
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    flags = WIDE * wide | NAMELESS * (doc_id is None)
    payload = LEAD.pack(flags, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()
    size = SIZE.pack(len(payload))
    return size + SUM.pack(masked(size)) + payload + SUM.pack(masked(payload))


def payload_at(data: memoryview, offset: int) -> bytes:
    """The checked payload of the record at ``offset``."""
    size, crc = HEAD.unpack_from(data, offset)
    if masked(SIZE.pack(size)) != crc:
        raise ValueError(f"the size of the record at {offset} is damaged")
    start = offset + HEAD.size
    payload = bytes(data[start : start + size])
    if len(payload) != size or masked(payload) != SUM.unpack_from(data, start + size)[0]:
        raise ValueError(f"the record at {offset} is damaged")
    return payload


def name_at(data: memoryview, offset: int) -> int | None:
    flags, doc_id = LEAD.unpack_from(data, offset + HEAD.size)
    return None if flags & NAMELESS else doc_id


def next_record(data: memoryview, offset: int) -> int:
    return offset + HEAD.size + SIZE.unpack_from(data, offset)[0] + SUM.size + 1


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = LEAD.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=LEAD.size)
    return (None if flags & NAMELESS else doc_id), ids


class WordEncoder:
    """A tokenizer that drops white space and never joins words, one word at a time.

    The words of many texts are numbered by Arrow, and each different word is looked at once. Ids of the first
    ``room`` different pieces of words are remembered. A new word is cut into its pieces here, as the tokenizer
    would cut it, and only a new piece goes through the tokenizer's merges; words with characters beyond the
    Latin ones, and all words of a tokenizer with other rules, go through the whole tokenizer one by one.
    """

    def __init__(self, path: str, room: int = 300_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer, self.room = Tokenizer.from_file(path), room
        self.model, self.cuts = self.tokenizer.model, has_known_rules(self.tokenizer)
        self.known: dict[bytes, bytes] = {b"": b""}
        if self._whole(["a b\n c."])[0] != b"".join(self._whole(["a", "b", "c", "."])):
            raise ValueError("this tokenizer does not treat words by themselves")

    def _whole(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [packed(e.ids) for e in found]

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(BYTE_LEVEL)
        return packed([token.id for token in self.model.tokenize(text)])

    def encode(self, texts: pa.Array | list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text; a null text has none."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("")
        # The tokenizer lowers case itself, but for the names of its special tokens.
        split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))
        numbered = split.flatten().dictionary_encode()
        words = values_of(numbered.dictionary)
        found = list(map(self.known.get, words))
        unknown = gaps(found)
        for i, ids in zip(unknown, self._new([words[i] for i in unknown]), strict=True):
            found[i] = ids
        if not words:
            yield from (np.zeros(0, "<u4") for _ in texts)
            return
        # Bytes of all texts in a row, and where each word begins and ends.
        placed = pa.array(found, pa.large_binary()).take(numbered.indices)
        ends = np.frombuffer(placed.buffers()[1], np.int64)[split.offsets.to_numpy() - split.offsets[0].as_py()]
        data = placed.buffers()[2]
        ids = np.frombuffer(data, "<u4") if data is not None and data.size else np.zeros(0, "<u4")
        for a, b in pairwise((ends // 4).tolist()):
            yield ids[a:b]

    def _new(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are not known yet; pieces, and words without such, become known while there is room."""
        known, fresh, out, odd = self.known, {}, [], []
        for w in words:
            pieces = pieces_of(w) if self.cuts else None
            if pieces is None:
                odd.append((len(out), w))
                out.append(b"")
                continue
            ids = []
            for piece in pieces:
                found = known.get(piece) or fresh.get(piece)
                if found is None:
                    found = fresh[piece] = self._piece(piece)
                ids.append(found)
            out.append(ids[0] if len(ids) == 1 else b"".join(ids))
        for (i, w), ids in zip(odd, self._whole([w.decode() for _, w in odd]), strict=True):
            out[i] = fresh[w] = ids
        known.update(islice(fresh.items(), max(0, self.room - len(known))))
        return out


def values_of(strings: pa.StringArray) -> list[bytes]:
    """The values of an array without nulls, as bytes."""
    if not len(strings):
        return []
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + len(strings) + 1].tolist()
    data = data.to_pybytes() if data is not None else b""
    return [data[a:b] for a, b in pairwise(ends)]


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}


def has_known_rules(tokenizer: Tokenizer) -> bool:
    """Whether ``pieces_of`` cuts words as this tokenizer does."""
    spec = json.loads(tokenizer.to_str())
    return spec["model"]["type"] == "BPE" and all(spec[k] == v for k, v in RULES.items())


def of_kind(kind: str) -> str:
    """The Latin characters of a Unicode category."""
    return "".join(c for c in map(chr, range(0xA1, 0x250)) if category(c)[0] == kind)


# Characters here have no composed forms other than themselves, and the white space among them is left out.
LATIN = re.compile("[!-~\u00a1-\u024f]+")
PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[a-zA-Z{of_kind("L")}]+|[0-9{of_kind("N")}]|[^a-zA-Z0-9{of_kind("L")}{of_kind("N")}]+"
)
MARKS = (b".", b",")
# A byte-level vocabulary writes a byte as itself if it is a visible Latin-1 character, else as one from U+0100 on.
VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LEVEL = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)).difference(VISIBLE)))}


def pieces_of(word: bytes) -> list[bytes] | None:
    """The pieces that are merged by themselves, in lower case; None if the word is not all Latin or may hold a special token."""
    stem = word[:-1] if word.endswith(MARKS) else word
    if stem.isalpha() and stem.islower():
        return [word] if stem is word else [stem, word[-1:]]
    text = word.decode()
    if word.isascii():
        if b"<|" in word or not text.isprintable():
            return None
        return [piece.encode() for piece in PIECES.findall(text.lower())]
    if b"<|" in word or not LATIN.fullmatch(text):
        return None
    if text.islower() and text.isalpha():
        return [word]
    text = text.lower()
    return [piece.encode() for piece in PIECES.findall(text)] if LATIN.fullmatch(text) else None


def gaps(found: list) -> list[int]:
    """Places of None, by the list's own search: most words are known."""
    out, at = [], -1
    for _ in range(found.count(None)):
        at = found.index(None, at + 1)
        out.append(at)
    return out


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and vocabulary."""
    return worker_state(("token_records", path), lambda: WordEncoder(path))


def in_parts(texts: pa.Array, chars: int = 4_000_000) -> Iterator[range]:
    """Ranges of rows with about ``chars`` bytes of text each."""
    start, size = 0, 0
    for i, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        size += n
        if size >= chars:
            yield range(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield range(start, len(texts))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    return public_tokenizers.path(name)


def write_records(docs: DataFrame, out: str, vocabulary: str, end_id: int = 2, file_bytes: int = 16 << 20,
                  id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the records to ``out/records``, the index to ``out/index``.

    ``vocabulary`` is a path that every executor has. Range partitions of about ``file_bytes`` of text
    become one file each; repeated ids are told apart by their text, so they can spread, too.
    """
    spark = docs.sparkSession
    docs = id_and_text(docs, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = ["doc_id", F.xxhash64("text")]
    placed = docs.repartitionByRange(max(1, -(-size // file_bytes)), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        end = np.array([end_id], "<u4")
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for part in in_parts(texts):
                found = words.encode(texts.slice(part.start, len(part)))
                frames = [frame(ids[i].as_py(), np.concatenate((x, end))) for i, x in zip(part, found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

    # The bytes pass through the text sink as they are; only its line feed is added.
    placed.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value")).write.text(f"{out}/records")
    index_of(spark, out).write.parquet(f"{out}/index")


def files(spark: SparkSession, out: str) -> DataFrame:
    """``(file, content)``: one row per record file."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{out}/records")
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    )


def index_of(spark: SparkSession, out: str) -> DataFrame:
    """File, place, offset and size of every record, and the id of its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file"), batch.column("content"), strict=True):
                data, offset, rows = memoryview(content.as_buffer()), 0, []
                while offset < len(data):
                    after = next_record(data, offset)
                    rows.append((file.as_py(), len(rows), offset, after - offset, name_at(data, offset)))
                    offset = after
                yield to_batch(rows, INDEX)

    return files(spark, out).mapInArrow(run, "file string, place long, offset long, size long, doc_id long")


def read_index(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/index")


def read_records(spark: SparkSession, out: str, picked: DataFrame | None = None) -> DataFrame:
    """``(doc_id, ids)`` of all records, or of those that ``picked`` rows of the index name."""
    stored = files(spark, out)
    if picked is None:
        stored = stored.withColumn("offsets", F.lit(None).cast("array<long>"))
    else:
        # As many offsets per file as a file of bounded size has records.
        stored = stored.join(picked.groupBy("file").agg(F.sort_array(F.collect_list("offset")).alias("offsets")), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, offsets in zip(batch.column("content"), batch.column("offsets"), strict=True):
                data, rows, size = memoryview(content.as_buffer()), [], 0
                for offset in offsets.as_py() if offsets.is_valid else walk(data):
                    doc_id, ids = parse(payload_at(data, offset))
                    rows.append((doc_id, ids.astype(np.int32)))
                    size += len(ids)
                    if size > 1_000_000:
                        yield to_batch(rows, RECORDS)
                        rows, size = [], 0
                if rows:
                    yield to_batch(rows, RECORDS)

    return stored.mapInArrow(run, "doc_id long, ids array<int>")


def walk(data: memoryview) -> Iterator[int]:
    offset = 0
    while offset < len(data):
        yield offset
        offset = next_record(data, offset)


def summaries(spark: SparkSession, out: str) -> DataFrame:
    """Per record, read from the files: its id, the ids before it over all files, their number and checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file"), batch.column("content"), strict=True):
                data, before, rows, name = memoryview(content.as_buffer()), 0, [], file.as_py()
                for offset in walk(data):
                    doc_id, ids = parse(payload_at(data, offset))
                    rows.append((name, doc_id, before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    before += len(ids)
                yield to_batch(rows, DIGEST)

    rows = materialize(
        files(spark, out).mapInArrow(run, "file string, doc_id long, before long, n_tokens long, ids_crc32 long"), "records"
    )
    # One row per file, so the running sum sees a short list.
    earlier = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).select(
        "file", "n", F.regexp_extract("file", r"part-(\d+)", 1).cast("long").alias("number")
    )
    starts = totals.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    return rows.join(starts, "file").select("doc_id", (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def digest(docs: DataFrame) -> DataFrame:
    """Rows of the query: write the records of all documents, then read the files back."""
    spark = docs.sparkSession
    out = scratch_path(spark, "token-records")
    write_records(docs, out, tokenizer_path())
    return summaries(spark, out)
