"""Fuzzy dictionary join: through shared deletions for one edit, through segments for more."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.distance import edit_distance
from granary.functions.text import exploded


def deletions(word: Column, k: int, whole: bool = False) -> Column:
    """The word and every string left after deleting up to ``k`` of its characters.

    The last character is never deleted, so two one-letter words share nothing, unless ``whole``:
    then words of at most ``k`` characters leave the empty string as well.
    """
    found = F.array(word)
    level = F.array(word)
    for _ in range(k):
        level = F.array_distinct(
            F.flatten(
                F.transform(
                    F.filter(level, lambda w: F.length(w) > 1),
                    lambda w: F.transform(
                        F.sequence(F.lit(1), F.length(w)),
                        lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))),
                    ),
                )
            )
        )
        found = F.array_union(found, level)
    return F.when(F.length(word) <= k, F.array_union(found, F.array(F.lit("")))).otherwise(found) if whole else found


def fuzzy_candidates(words: DataFrame, word: str, dictionary: DataFrame, entry: str, k: int, whole: bool = False) -> DataFrame:
    """Pairs that share a deletion string, among them the pairs within distance ``k``.

    Both sides are distinct words. A deletion string is shared by the words that come from
    it by at most ``k`` insertions, a number set by the alphabet and not by the data.
    """
    left = exploded(words.select(word).distinct(), [word], deletions(F.col(word), k, whole), "_d")
    right = exploded(dictionary.select(entry).distinct(), [entry], deletions(F.col(entry), k, whole), "_d")
    close = F.abs(F.length(word) - F.length(entry)) <= k
    return left.join(right, "_d").filter(close).select(word, entry).distinct()


#: Ways in which very short words of either side are dealt out; their pairs are all results.
GRID = 8
#: Words of more letters have segments that are long enough to tell words apart; shorter ones have
#: some hundred deletion strings at most.
LONG = 11


def _letters(word: Column) -> Column:
    """A bit for each letter in the word, by a hash; an edit changes two of them at most."""
    one = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(c), F.lit(63)).cast("int"))
    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda a, c: a.bitwiseOR(one(c)))


def _segment(length: Column, i: Column, k: int) -> tuple[Column, Column]:
    """Start (from 0) and size of segment ``i`` of k + 1 in a word of at least 2 k + 1 letters.

    Between segments one letter is left out, so that no edit, not even a swap, touches two of them.
    """
    base, longer = F.floor((length - k) / F.lit(k + 1)).cast("int"), F.pmod(length - k, F.lit(k + 1))
    more = F.greatest(i - (k + 1 - longer), F.lit(0))
    return i * (base + 1) + more, base + (i >= k + 1 - longer).cast("int")


def _shortened(word: Column, k: int) -> Column:
    return F.transform(deletions(word, k), lambda x: F.concat(F.lit("d "), x))


def _marks(word: Column, k: int) -> Column:
    """Keys of a dictionary entry: its segments, or its deletion strings if it is short, and its place in the grid."""
    n = F.length(word)
    steps = F.sequence(F.lit(0), F.lit(k))
    long = F.transform(steps, lambda i: F.concat_ws(" ", F.lit("s"), n, i, F.substring(word, _segment(n, i, k)[0] + 1, _segment(n, i, k)[1])))
    own = F.pmod(F.hash(word), F.lit(GRID))
    grid = F.transform(F.sequence(F.lit(0), F.lit(GRID - 1)), lambda h: F.concat_ws(" ", F.lit("x"), own, h))
    return F.when(n > LONG, long).when(n > k, _shortened(word, k)).otherwise(F.concat(_shortened(word, k), grid))


def _probes(word: Column, k: int) -> Column:
    """Keys that an entry within ``k`` edits of the word has at least one of."""
    n = F.length(word)
    none = F.array().cast("array<string>")
    shifts, steps = F.sequence(F.lit(-k), F.lit(k)), F.sequence(F.lit(0), F.lit(k))

    def at(m: Column, i: Column, shift: Column) -> Column:
        start, size = _segment(m, i, k)
        inside = (start + shift >= 0) & (start + shift + size <= n)
        return F.when(inside, F.concat_ws(" ", F.lit("s"), m, i, F.substring(word, start + shift + 1, size)))

    lengths = F.sequence(F.greatest(n - k, F.lit(LONG + 1)), n + k)
    long = F.flatten(F.transform(lengths, lambda m: F.flatten(F.transform(steps, lambda i: F.transform(shifts, lambda d: at(m, i, d))))))
    own = F.pmod(F.hash(word), F.lit(GRID))
    grid = F.transform(F.sequence(F.lit(0), F.lit(GRID - 1)), lambda g: F.concat_ws(" ", F.lit("x"), g, own))
    parts = F.concat(
        F.when(n + k > LONG, long).otherwise(none), F.when(n - k <= LONG, _shortened(word, k)).otherwise(none), F.when(n <= k, grid).otherwise(none)
    )
    return F.array_distinct(F.filter(parts, lambda x: x.isNotNull()))


def segment_candidates(words: DataFrame, word: str, dictionary: DataFrame, entry: str, k: int) -> DataFrame:
    """Pairs among which are all within ``k`` edits, a swap of neighbours being one.

    An entry of more than LONG letters is cut into k + 1 segments with a letter left out between
    them; k edits leave one of them whole, at most k places off. A shorter entry shares with the
    word what is left of both after at most k deletions, some letter at least, unless both have
    at most k letters: such pairs are all results, and they meet in a grid. Empty words have no
    partners; ``k`` is at most LONG / 2.
    """
    left = words.select(word).distinct().where(F.length(word) > 0).withColumn("_lw", _letters(F.col(word)))
    right = dictionary.select(entry).distinct().where(F.length(entry) > 0).withColumn("_le", _letters(F.col(entry)))
    left = exploded(left, [word, "_lw"], _probes(F.col(word), k), "_d")
    right = exploded(right, [entry, "_le"], _marks(F.col(entry), k), "_d")
    near = (F.abs(F.length(word) - F.length(entry)) <= k) & (F.bit_count(F.col("_lw").bitwiseXOR(F.col("_le"))) <= 2 * k)
    # pairs are small and their distances are not: as many tasks as configured, not as the bytes suggest
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return left.join(right, "_d").filter(near).select(word, entry).repartition(parts, word, entry).distinct()


def fuzzy_pairs_by_segments(words: DataFrame, word: str, dictionary: DataFrame, entry: str, k: int) -> DataFrame:
    """All pairs of word and dictionary entry within edit distance ``k``, neighbours' swaps counting one."""
    pairs = segment_candidates(words, word, dictionary, entry, k)
    return pairs.withColumn("distance", edit_distance(F.col(word), F.col(entry))).filter(F.col("distance") <= k)


def fuzzy_pairs(words: DataFrame, word: str, dictionary: DataFrame, entry: str, k: int, whole: bool = False) -> DataFrame:
    """Pairs of word and dictionary entry within edit distance ``k``, neighbours' swaps counting one.

    All of them if ``whole``, otherwise without pairs of words that have no common letter left.
    """
    pairs = fuzzy_candidates(words, word, dictionary, entry, k, whole)
    return pairs.withColumn("distance", edit_distance(F.col(word), F.col(entry))).filter(F.col("distance") <= k)


def best_suggestions(pairs: DataFrame, word: str, entry: str, frequency: str) -> DataFrame:
    """Best entry per word: smallest distance, then highest frequency, then alphabet."""
    rank = F.struct(F.col("distance"), (-F.col(frequency)).alias("f"), F.col(entry).alias("e"))
    picked = F.struct(F.col(entry), F.col("distance"), F.col(frequency))
    return pairs.groupBy(word).agg(F.min_by(picked, rank).alias("_b")).select(word, "_b.*")
