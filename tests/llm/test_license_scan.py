from collections import Counter

import pytest

from almsbook.llm import license_scan as ls
from frames import docs, prose

MIT = ls.TEMPLATES["mit"][0]


def plain_dice(a, b):
    a, b = (ls.words_in(x) for x in (a, b))
    a, b = (Counter(zip(x, x[1:])) if len(x) > 1 else Counter((w,) for w in x) for x in (a, b))
    return 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values()))


def brute(text, least=0.8):
    """Best template of every run of lines, best runs first, without bounds."""
    lines = text.split("\n")
    found = []
    for i in range(len(lines)):
        for j in range(i, len(lines)):
            part = " ".join(lines[i : j + 1])
            if ls.words_in(part) and ls.words_in(lines[i]) and ls.words_in(lines[j]):
                score, name = min((-plain_dice(part, t), n) for n, ts in ls.TEMPLATES.items() for t in ts)
                if -score >= least:
                    found.append((score, i - j, i, name, j))
    out = []
    for score, _, i, name, j in sorted(found):
        if all(j < a or i > b for _, _, a, b in out):
            out.append((name, pytest.approx(-score), i, j))
    return sorted(out, key=lambda m: m[2])


@pytest.mark.parametrize("text", [
    MIT, prose(1, 80) + "\nAll rights reserved.\n" + prose(2, 50), "Released under the MIT licence.", "all\nrights\nreserved",
    "\n".join(MIT[i : i + 90] for i in range(0, len(MIT), 90)), "# " + MIT.upper() + "\n\nLicensed under CC BY-NC 4.0!!\n" + prose(3, 9),
    MIT[: len(MIT) // 2], prose(4, 300), "All rights reserved.\nAll rights reserved.",
])
def test_against_brute_force(text):
    assert ls.default_scanner(0.8).scan(text) == brute(text)


@pytest.mark.parametrize("text, names", [
    ("Copyright 2024 Example Corp. All rights reserved.", ["all-rights-reserved"]),
    ("Copyright (c) 2020 X. Licensed under the MIT License.", ["mit-notice"]),
    (prose(8, 40) + " " + MIT + " " + prose(9, 40) + " All rights reserved. " + prose(10, 9), ["mit", "all-rights-reserved"]),
    (ls.BSD_CONDITIONS + "\n" + ls.BSD_DISCLAIMER, ["bsd-2-clause"]), (ls.TEMPLATES["bsd-3-clause"][0], ["bsd-3-clause"]),
    (prose(1, 30) + "\n" + ls.program_header("program", "GNU General Public License", "2"), ["gpl-2.0-notice"]),
    (ls.program_header("program", "GNU Affero General Public License", "3"), ["agpl-3.0-notice"]),
    (prose(2, 30) + "\n" + ls.full_text("GPL-3") + "\n" + prose(3, 30), ["gpl-3.0"]), (ls.full_text("MPL-2.0"), ["mpl-2.0"]),
])
def test_families_full_texts_and_notices_within_a_line(text, names):
    assert [m[0] for m in ls.default_scanner(0.8).scan(text)] == names


def test_size_bounds_hold():
    scanner = ls.default_scanner(0.8)
    for text in (MIT, MIT[:500], "All rights reserved", "Licensed under the MIT License"):
        best = min((-plain_dice(text, t), n) for n, ts in ls.TEMPLATES.items() for t in ts)
        assert scanner.best(ls.words_in(text)) == ((pytest.approx(-best[0]), best[1]) if -best[0] >= 0.8 else None)


def test_rows(spark):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "All rights reserved."), (4, "All rights reserved."), (None, "All rights reserved."), (5, prose(5, 30_000))]
    found = ls.scan(docs(spark, *rows)).collect()
    assert sorted((str(r["doc_id"]), r["license"], r["dice"], r["first_line"], r["last_line"]) for r in found) == [
        ("4", "all-rights-reserved", 1.0, 0, 0), ("4", "all-rights-reserved", 1.0, 0, 0), ("None", "all-rights-reserved", 1.0, 0, 0)]
    assert ls.scan(docs(spark)).collect() == [] and ls.scan(docs(spark, *rows), {}).collect() == []
    own = ls.scan(docs(spark, *rows), {"own": ["rights reserved all", "all rights reserved"]}).collect()
    assert {r["license"] for r in own} == {"own"}
