"""Text jobs on one long table of (document, term) rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions.text import exploded, ngrams
from granary.operators.skew import number_rows
from granary.session import durable


def vocabulary(df: DataFrame, text: str, pattern: str = r"[\p{L}]+") -> DataFrame:
    """Distinct lower-case words with their number of occurrences."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"({pattern})"), 1)
    return exploded(df, [], words, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def _run_starts(sorted_values: Column) -> Column:
    """Positions in a sorted array where a new value begins."""
    places = F.transform(
        sorted_values, lambda v, i: F.when((i == 0) | (v != F.get(sorted_values, i - 1)), i)
    )
    return F.filter(places, lambda i: i.isNotNull())


def _counted(df: DataFrame, id_col: str, values: Column) -> DataFrame:
    """Per row the distinct values of an array with their counts, as ``_r`` array of (value, count).

    Each step is a column of its own, so that no step is computed once per element.
    """
    staged = df.select(id_col, F.sort_array(values).alias("_s"))
    staged = staged.select(id_col, "_s", _run_starts(F.col("_s")).alias("_b"))
    ends = lambda j: F.coalesce(F.get(F.col("_b"), j + 1), F.size("_s"))
    runs = F.transform(
        "_b", lambda b, j: F.struct(F.get(F.col("_s"), b).alias("value"), (ends(j) - b).cast("long").alias("count"))
    )
    return staged.select(id_col, runs.alias("_r"))


def term_counts(df: DataFrame, id_col: str, words: Column) -> DataFrame:
    """Occurrences of each term in each document, one document per row of ``df``.

    The words of a row are sorted and counted inside the row, so nothing is shuffled.
    """
    rows = exploded(_counted(df, id_col, words).withColumnRenamed("_r", "_a"), [id_col], F.col("_a"), "_r")
    return rows.select(id_col, F.col("_r.value").alias("term"), F.col("_r.count").alias("tf"))


def group_term_counts(df: DataFrame, groups: Sequence[str], words: Column) -> DataFrame:
    """Occurrences of each term in each group of documents."""
    long = exploded(df, groups, words, "term")
    return long.groupBy(*groups, "term").agg(F.count(F.lit(1)).alias("n"))


def ngram_frequencies(df: DataFrame, words: Column, n: int, top: int | None = None) -> DataFrame:
    """Occurrences of each n-gram over all documents, most frequent first."""
    # the words are a column of their own, so that they are split once per text and not once per n-gram
    staged = df.select(words.alias("_w"))
    grams = exploded(staged, [], ngrams(F.col("_w"), n), "ngram")
    counts = grams.groupBy("ngram").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "ngram").limit(top) if top else counts


def keyword_in_context(df: DataFrame, id_col: str, words: Column, phrase: Sequence[str], window: int) -> DataFrame:
    """Every occurrence of a phrase with the words around it; only matches leave their row."""
    m = len(phrase)
    staged = df.select(id_col, words.alias("w"))
    starts = F.when(F.size("w") >= m, F.sequence(F.lit(1), F.size("w") - (m - 1))).otherwise(F.array().cast("array<int>"))

    def matches(i: Column) -> Column:
        return reduce(lambda a, b: a & b, [F.get(F.col("w"), i + (j - 1)) == F.lit(p) for j, p in enumerate(phrase)])

    hits = F.filter(starts, matches)
    at = exploded(staged, [id_col, "w"], hits, "position")
    first = F.greatest(F.col("position") - window, F.lit(1))
    return at.select(
        id_col,
        "position",
        F.array_join(F.slice("w", first, F.col("position") - first), " ").alias("before"),
        F.array_join(F.slice("w", F.col("position"), F.lit(m)), " ").alias("keyword"),
        F.array_join(F.slice("w", F.col("position") + m, F.lit(window)), " ").alias("after"),
    )


def vocabulary_ids(df: DataFrame, words: Column) -> DataFrame:
    """Word ids 1, 2, ... by falling frequency, ties by the alphabet."""
    counts = exploded(df, [], words, "term").groupBy("term").agg((-F.count(F.lit(1))).alias("_neg"))
    numbered = number_rows(counts, ["_neg", "term"], "word_id")
    return numbered.select("term", "word_id", (-F.col("_neg")).alias("n"))


def id_sequences(df: DataFrame, id_col: str, words: Column, ids: DataFrame, length: int) -> DataFrame:
    """Word ids of each document in order, cut and padded on the left to a fixed length.

    A document's words are already one row, so collecting them again is bounded by the
    text. Only the last ``length`` words can appear in the result, so only they are moved.
    """
    staged = df.select(id_col, words.alias("_w")).withColumn("_n", F.size("_w"))
    kept = staged.select(
        id_col,
        "_n",
        F.posexplode_outer(F.slice("_w", F.greatest(F.col("_n") - (length - 1), F.lit(1)), F.lit(length))).alias("_pos", "term"),
    )
    coded = kept.join(ids.select("term", "word_id"), "term", "left")
    # positions are at most ``length``, so the list of a document is bounded
    listed = coded.groupBy(id_col, "_n").agg(
        F.array_sort(F.collect_list(F.when(F.col("word_id").isNotNull(), F.struct("_pos", "word_id")))).alias("_s")
    )
    seq = F.transform("_s", lambda x: x["word_id"])
    padding = F.array_repeat(F.lit(0).cast("long"), F.lit(length) - F.size(seq))
    return listed.select(id_col, F.col("_n").alias("full_length"), F.concat(padding, seq).alias("sequence"))


def top_terms(counts: DataFrame, group: Sequence[str], measure: str, k: int) -> DataFrame:
    """The k highest terms per group.

    The rank filter is pushed below the shuffle, so each task sends at most k rows per group.
    """
    w = Window.partitionBy(*group).orderBy(F.col(measure).desc(), "term")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def document_frequencies(counts: DataFrame) -> DataFrame:
    """Documents per term, from (document, term) rows."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def prune_by_document_frequency(counts: DataFrame, documents: Column, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """Keep terms in at least ``min_df`` documents and, for ``max_df`` below 1, at most that share of them."""
    if not 0.0 < max_df <= 1.0:
        raise ValueError("max_df is a share of the documents in (0, 1]")
    kept = document_frequencies(counts).filter(F.col("df") >= min_df)
    if max_df < 1.0:
        kept = kept.filter(F.col("df") <= documents * F.lit(max_df))
    # written, so that what counting them shuffled is gone before the cells move
    return counts.join(durable(kept.select("term")), "term", "left_semi")


def shared_terms(left: DataFrame, right: DataFrame, min_df: int = 1) -> tuple[DataFrame, DataFrame]:
    """Both (document, term) tables reduced to the terms present in each of them."""
    l_terms = document_frequencies(left).filter(F.col("df") >= min_df).select("term")
    r_terms = document_frequencies(right).filter(F.col("df") >= min_df).select("term")
    common = l_terms.join(r_terms, "term", "left_semi")
    return left.join(common, "term", "left_semi"), right.join(common, "term", "left_semi")


def inverse_document_frequencies(counts: DataFrame, documents: Column) -> DataFrame:
    """Smoothed idf: ``ln((1 + documents) / (1 + df)) + 1``."""
    df = document_frequencies(counts)
    return df.select("term", "df", (F.ln((documents + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def tf_idf(counts: DataFrame, id_col: str, documents: Column) -> DataFrame:
    """Weights with unit length per document."""
    idf = inverse_document_frequencies(counts, documents)
    raw = counts.join(idf.select("term", "idf"), "term").withColumn("_w", F.col("tf") * F.col("idf"))
    # one document's distinct terms: bounded by its text
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", "tf", (F.col("_w") / norm).alias("weight"))


def largest_vocabulary(counts: DataFrame, size: int) -> DataFrame:
    """Keep the ``size`` terms with the most occurrences overall."""
    totals = counts.groupBy("term").agg(F.sum("tf").alias("_all"))
    kept = totals.orderBy(F.col("_all").desc(), "term").limit(size).select("term")
    return counts.join(kept, "term", "left_semi")


def hashed_counts(
    df: DataFrame, id_col: str, words: Column, sizes: Sequence[int], buckets: int, signed: bool = True
) -> DataFrame:
    """Counts of n-grams in hash buckets, scaled to unit length per document.

    With ``signed`` the sign of the hash decides whether a gram counts up or down, so that
    colliding grams cancel instead of adding up.
    """
    grams = F.concat(*[ngrams(F.col("_w"), n) for n in sizes])

    def code(gram: Column) -> Column:
        # bucket in the upper bits, direction in the lowest
        h = F.xxhash64(gram)
        up = F.when(h >= 0, F.lit(1)).otherwise(F.lit(0)) if signed else F.lit(1)
        return F.pmod(h, F.lit(buckets)) * 2 + up

    words_of = df.select(id_col, words.alias("_w"))
    runs = _counted(words_of, id_col, F.transform(grams, code))
    bucket = lambda r: F.shiftright(r["value"], 1)
    signed_count = lambda r: F.when(r["value"] % 2 == 1, r["count"]).otherwise(-r["count"])

    def merged(r: Column, j: Column) -> Column:
        # the two directions of one bucket are neighbours; the first of them carries both
        before, after = F.get(F.col("_r"), j - 1), F.get(F.col("_r"), j + 1)
        opens = (j == 0) | (bucket(before) != bucket(r))
        other = F.when(bucket(after) == bucket(r), signed_count(after)).otherwise(F.lit(0))
        return F.when(opens, F.struct(bucket(r).alias("bucket"), (signed_count(r) + other).alias("n")))

    counted = runs.select(id_col, F.filter(F.transform("_r", merged), lambda r: r.isNotNull()).alias("_r"))
    square = F.aggregate("_r", F.lit(0).cast("long"), lambda acc, r: acc + r["n"] * r["n"])
    measured = counted.select(id_col, F.sqrt(square).alias("_norm"), F.col("_r").alias("_a"))
    rows = exploded(measured, [id_col, "_norm"], F.col("_a"), "_r")
    return rows.select(id_col, "_r.bucket", "_r.n", (F.col("_r.n") / F.nullif(F.col("_norm"), F.lit(0.0))).alias("weight"))


def bm25(
    documents: DataFrame,
    id_col: str,
    words: Column,
    questions: DataFrame,
    question_id: str,
    question_words: Column,
    top: int,
    k1: float = 1.2,
    b: float = 0.75,
) -> DataFrame:
    """The best documents for each question of a batch, over a block-max index.

    Documents of similar words are neighbours in blocks of BLOCK, and each block knows the
    largest contribution of each of its terms. A question's ``top``-th score is at least the
    ``top``-th contribution of any of its terms, and at least the ``top``-th score in its FIRST
    most promising blocks; of the other blocks only those are scored whose bound, the sum of
    the largest contributions, reaches that. The result is exact.
    Postings of words that no question uses are left out from the start.
    """
    index = BlockMaxIndex(documents, id_col, words, questions, question_id, question_words, k1, b)
    scored = index.scored(top)
    w = Window.partitionBy(question_id).orderBy(F.round("score", 9).desc(), id_col)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


#: Documents of a block, and blocks that every question scores.
BLOCK, FIRST = 32, 4


class BlockMaxIndex:
    """Postings (block, term, document, contribution) and block maxima, for the terms of the questions."""

    def __init__(self, documents: DataFrame, id_col: str, words: Column, questions: DataFrame, question_id: str, question_words: Column, k1: float, b: float):
        self.id_col, self.question_id = id_col, question_id
        asked = term_counts(questions, question_id, question_words).withColumnRenamed("tf", "_qtf")
        used = asked.select("term").distinct()
        # the smallest hash of a document's words is shared by documents of similar words
        like = F.array_min(F.transform("_w", lambda x: F.xxhash64(x)))
        staged = durable(documents.select(id_col, words.alias("_w")).withColumn("_len", F.size("_w")).withColumn("_like", like))
        corpus = staged.agg(F.count(F.lit(1)).alias("n"), F.avg("_len").alias("mean")).first()
        total, mean_length = corpus["n"], corpus["mean"]
        numbered = number_rows(staged.select(id_col, "_like"), ["_like", id_col], "_no")
        places = numbered.select(id_col, F.floor((F.col("_no") - 1) / BLOCK).alias("_block"))
        # terms are counted inside the row, so postings move and texts don't
        counts = term_counts(staged.select(F.struct(id_col, "_len").alias("_d"), "_w"), "_d", F.col("_w")).join(used, "term", "left_semi")
        saturation = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("_d._len") / mean_length))
        flat = counts.select(F.col(f"_d.{id_col}").alias(id_col), "term", saturation.alias("_sat"))
        self.postings = durable(flat.join(places, id_col))
        df = self.postings.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
        self.weights = durable(asked.join(df, "term").select(
            question_id, "term", (F.col("_qtf") * F.ln(1 + (total - F.col("_df") + 0.5) / (F.col("_df") + 0.5))).alias("_idf")
        ))
        self.maxima = self.postings.groupBy("_block", "term").agg(F.max("_sat").alias("_most"))

    def _of(self, blocks: DataFrame) -> DataFrame:
        """Scores of all documents of the (question, block) rows that share a word with the question."""
        wanted = blocks.select(self.question_id, "_block").join(self.weights, self.question_id)
        met = wanted.join(self.postings, ["_block", "term"])
        return met.groupBy(self.question_id, self.id_col).agg(F.sum(F.col("_idf") * F.col("_sat")).alias("score"))

    def scored(self, top: int) -> DataFrame:
        """(question, document, score): every document that can be among the question's best, and some more."""
        q = self.question_id
        bounds = self.weights.join(self.maxima, "term").groupBy(q, "_block").agg(F.sum(F.col("_idf") * F.col("_most")).alias("_bound"))
        order = Window.partitionBy(q).orderBy(F.col("_bound").desc(), "_block")
        ranked = durable(bounds.withColumn("_rank", F.row_number().over(order)))
        # the ranks' limits reach below the shuffle: a task hands on ``top`` rows for a term or question
        heavy = Window.partitionBy("term").orderBy(F.col("_sat").desc())
        kth = self.postings.withColumn("_rank", F.row_number().over(heavy)).where(F.col("_rank") <= top).where(F.col("_rank") == top)
        alone = self.weights.join(kth.select("term", "_sat"), "term").groupBy(q).agg(F.max(F.col("_idf") * F.col("_sat")).alias("_bar"))
        first = durable(self._of(ranked.where(F.col("_rank") <= FIRST)))
        best = Window.partitionBy(q).orderBy(F.col("score").desc())
        among = first.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= top).where(F.col("_rank") == top)
        bars = alone.unionByName(among.select(q, F.col("score").alias("_bar"))).groupBy(q).agg(F.max("_bar").alias("_bar"))
        # a little is allowed for the order in which sums are rounded
        reach = F.col("_bar").isNull() | (F.col("_bound") * (1 + 1e-9) + 1e-8 >= F.col("_bar"))
        rest = ranked.where(F.col("_rank") > FIRST).join(bars, q, "left").where(reach)
        return first.unionByName(self._of(rest))
