"""Name and e-mail normalisation without UDFs."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse_spaces(text: Column) -> Column:
    """Runs of any Unicode white space become one space; none remain at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def name_key(name: Column) -> Column:
    """Key under which differently cased or spaced spellings of a name meet."""
    return F.lower(collapse_spaces(name))


def title_case(text: Column) -> Column:
    """Upper-case each letter that follows a non-letter and lower-case the others.

    ``initcap`` only looks at white space, which leaves "o'neil" and "smith-jones" half done.
    """
    words = F.split(F.lower(text), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), ""
    )


def display_name(name: Column) -> Column:
    return title_case(collapse_spaces(name))


def normal_email(email: Column) -> Column:
    return F.lower(F.trim(email))
