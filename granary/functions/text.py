"""Text scalar expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII punctuation, digits and line controls (fixed value)
NOISE = r"[!-/:-@\[-`{-~0-9\r\t\n]"

# stop words of the listing featurisers (fixed values)
LISTING_STOP_WORDS = ["the", "a", "an", "is", "it", "this"]

# common function words of the languages in the tables
STOP_WORDS = (
    "a an and are as at be but by for from has have he in is it its not of on or she that the their they "
    "this to was were which will with you your "
    "au aux avec ce ces dans de des du elle en et il je la le les leur mais ne nous on ou par pas pour que qui "
    "sur une un vous "
    "aber als auch auf das dem den der des die ein eine er es für ich im ist mit nicht sich sie und von zu "
    "al como con del el ella los las lo más no para por se sin su"
).split()
STOP_WORDS = sorted(set(STOP_WORDS))

# number and carat spellings, number and two-letter unit (fixed values)
CARATS = r"(\d)([\s-]?)(karat|karats|carat|carats|kt)([^\w])"
UNITS = r"(\d+)[\s-]([a-z]{2})(\s)"

# values that stand for "nothing recorded" in web session exports (fixed values)
SENTINELS = ["(not set)", "(none)", "unknown.unknown", "(not provided)", "not available in demo dataset"]


def exploded(df: DataFrame, keep: Sequence[str], array: Column, name: str) -> DataFrame:
    """One row per array element beside the kept columns; empty arrays give none.

    The plain ``explode`` lets the optimiser infer a filter on the array size and push it
    to the scan, which computes the array once more per row (and the steps of a staged array
    many times). The outer form with a filter on its result does not.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def compose(*parts: Column) -> Column:
    """Lower-case parts joined by blanks; a missing part leaves its separator."""
    pieces = [F.coalesce(F.lower(p), F.lit("")) for p in parts]
    return F.concat_ws(" ", *pieces)


def normalise_units(text: Column) -> Column:
    """Carat spellings to ``<n>k``, then numbers glued to two-letter units."""
    return F.regexp_replace(F.regexp_replace(text, CARATS, "$1k$4"), UNITS, "$1$2$3")


def path_levels(path: Column, levels: int = 3, default: str = "other", sep: str = "/") -> list[Column]:
    """Levels of a category path; a path with fewer levels gives the default everywhere."""
    parts = F.split(path, sep)
    whole = path.isNotNull() & (F.size(parts) >= levels)
    return [F.when(whole, parts[i]).otherwise(F.lit(default)) for i in range(levels)]


def path_pair(path: Column, default: str = "other", sep: str = "/") -> Column:
    """The first two levels together, by the rule of :func:`path_levels`."""
    first, second, _ = path_levels(path, 3, default, sep)
    return F.concat_ws(sep, first, second)


def cleaned_words(text: Column, min_length: int, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Lower-case words without punctuation, digits, stop words and short words."""
    words = F.split(F.regexp_replace(F.lower(text), NOISE, " "), " ")
    return F.filter(words, lambda w: (F.length(w) >= min_length) & ~w.isin(*stop_words))


def word_count(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Words of more than three letters; a missing text counts none."""
    return F.coalesce(F.size(cleaned_words(F.coalesce(text, F.lit("")), 4, stop_words)), F.lit(0))


def tokens(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Words of at least three characters with at least one plain letter."""
    return F.filter(cleaned_words(text, 3, stop_words), lambda w: w.rlike("[a-z]"))


def ngrams(words: Column, n: int) -> Column:
    """Runs of ``n`` neighbouring words, joined by blanks.

    Pass a column that already exists: the words are looked up once per position.
    """
    if n == 1:
        return words
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(n)]))


def blank_token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def host_labels(url: Column) -> Column:
    return F.split(F.parse_url(url, F.lit("HOST")), r"\.")


def citation_year(citation: Column) -> Column:
    """Year that ends a citation, in brackets or not; NULL when there is none."""
    return F.regexp_extract(citation, r"(\d{4})\)?$", 1).try_cast("int")


def json_number(document: Column, key: str) -> Column:
    """Number under a key of a JSON text; 0 when the key is missing."""
    return F.coalesce(F.get_json_object(document, f"$.{key}").try_cast("double"), F.lit(0.0))


def json_text(document: Column, key: str) -> Column:
    """Text under a key of a JSON text; NULL when the key is missing."""
    return F.get_json_object(document, f"$.{key}")


def literal_to_json(document: Column) -> Column:
    """Dictionary text with single quotes and capitalised constants to JSON text."""
    quoted = F.replace(document, F.lit("'"), F.lit('"'))
    return F.regexp_replace(
        F.regexp_replace(F.regexp_replace(quoted, r"\bTrue\b", "true"), r"\bFalse\b", "false"), r"\bNone\b", "null"
    )
