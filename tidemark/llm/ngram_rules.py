"""Quality rules: base counts and a hashed n-gram log-likelihood ratio, in DataFrame expressions only.

Every unigram and bigram of a text falls into one of ``buckets`` hash buckets.
Multinomials over the buckets are counted on all rows: of the raw corpus,
and of the trusted target rows.  A text's ratio is the mean over its n-grams of
``ln p_target - ln p_raw`` (add-one smoothing), so it does not depend on length;
the text is kept if the ratio reaches the threshold and no base rule fails.

A text must not be judged by its own words.  So texts fall into two folds by a hash, equal texts into one,
and a text is judged by the trusted rows of the other fold; whether it is
trusted itself changes nothing.  The threshold is a rule, not a number: that under which ``LOST`` of the
trusted rows fall, judged in this way, to a thousandth.

The bucket weights are two arrays of fixed length, which a scalar subquery brings to the tasks.  Everything about
one text is computed inside its row; only bucket counts are shuffled.  The row comes out of a
generator, so a filter on the verdict works on what has been computed and is not pushed into it.

Rows: a null text has no words, like an empty one, and fails the base rules;
repeated rows are judged alike; a null ``doc_id`` is never trusted; other columns
are not read; an empty corpus or target leaves all ratios defined (smoothing), and without trusted rows the threshold is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, table

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
#: Parameters of the registered query.
BUCKETS, LOST = 1 << 16, 0.01
#: Ratios are told apart to this many parts of 1 when the threshold is chosen.
STEPS = 1000
#: Bits of a window's place in a text beside its hash.
PLACE_BITS = 20


def _without(text: str, chars: str) -> str:
    quoted = chars.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\t", "\\t").replace("\r", "\\r")
    return f"translate({text}, '{quoted}', '')"


def with_words(docs: DataFrame) -> DataFrame:
    """``doc_id, text, words``; the text is never null."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select("doc_id", text.alias("text"))
    return docs.withColumn("words", F.array_remove(F.split("text", SPACE), ""))


def fold(text: str = "text") -> Column:
    """0 or 1 by a hash of the text."""
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit("")), F.lit("fold")), F.lit(2)).cast("int")


def _gram_counts(docs: DataFrame, buckets: int, folds: bool = True) -> DataFrame:
    """``bucket, fold`` and the number ``n`` of unigrams and bigrams of all texts of a fold in it; without ``folds`` of all texts, as fold 0."""
    rows = docs.select((fold() if folds else F.lit(0)).alias("fold"), F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACE), "").alias("words"))
    rows = rows.select("fold", "words", F.expr("slice(words, 2, greatest(size(words) - 1, 0))").alias("next"))
    pairs = rows.select("fold", F.explode(F.arrays_zip("words", "next")).alias("p"))
    uni = F.pmod(F.xxhash64("p.words"), F.lit(buckets)).cast("int")
    bi = F.pmod(F.xxhash64("p.words", "p.next"), F.lit(buckets)).cast("int")
    both = F.when(F.col("p.next").isNull(), F.array(uni)).otherwise(F.array(uni, bi))
    return pairs.select("fold", F.explode(both).alias("bucket")).groupBy("bucket", "fold").agg(F.count("*").alias("n"))


def trusted_texts(docs: DataFrame, trusted: DataFrame, trusted_rows: int) -> DataFrame:
    """``text`` of the rows whose ``doc_id`` is in ``trusted``."""
    marks = small(trusted.select("doc_id").where("doc_id is not null").distinct(), trusted_rows, 32)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("doc_id is not null")
    return rows.join(marks, "doc_id", "left_semi").select("text")


def bucket_counts(docs: DataFrame, trusted: DataFrame, trusted_rows: int, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, raw, target_0, target_1``: n-gram counts over all rows, without a join, and over the trusted rows of each fold."""
    raw = _gram_counts(docs.select(F.col("text").cast("string").alias("text")), buckets, folds=False).select("bucket", "n", F.lit(0).alias("t0"), F.lit(0).alias("t1"))
    target = _gram_counts(trusted_texts(docs, trusted, trusted_rows), buckets)
    target = target.select("bucket", F.lit(0).alias("n"), F.when(F.col("fold") == 0, F.col("n")).otherwise(0).alias("t0"), F.when(F.col("fold") == 1, F.col("n")).otherwise(0).alias("t1"))
    both = raw.unionByName(target).groupBy("bucket")
    return both.agg(F.sum("n").alias("raw"), F.sum("t0").alias("target_0"), F.sum("t1").alias("target_1"))


def weights(counts: DataFrame, buckets: int = BUCKETS) -> tuple[list[float], list[float]]:
    """The log-ratio of every bucket for texts of fold 0 and of fold 1, each from the other's trusted rows; ``counts`` has at most ``buckets`` rows."""
    from math import log

    rows = {r.bucket: (r.raw, r.target_1, r.target_0) for r in counts.collect()}
    all_raw, *targets = (sum(r[i] for r in rows.values()) + buckets for i in range(3))
    none = (0, 0, 0)
    of = lambda i: [log((rows.get(b, none)[i] + 1) / targets[i - 1]) - log((rows.get(b, none)[0] + 1) / all_raw) for b in range(buckets)]
    return of(1), of(2)


def base_rules(words: DataFrame) -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` to ``doc_id, text, words``."""
    # A window's hash above its place in one long: equal windows stand side by side in sorted order.  If two
    # neighbours of one hash differ in words, or places do not fit, the text's windows are sorted as they are.
    exact = "filter(_w, (x, j) -> x.w = get(_w, j - 1).w or x.w = get(_w, j + 1).w)"
    windows = "array_sort(transform(sequence(0, size(words) - 3), i -> struct(concat(words[i], ' ', words[i + 1], ' ', words[i + 2]) as w, i as i)))"
    same = lambda a, b: f"shiftright({a}, {PLACE_BITS}) = shiftright({b}, {PLACE_BITS})"
    place = lambda x: f"cast({x} & {(1 << PLACE_BITS) - 1}L as int)"
    differ = " or ".join(f"get(words, {place('get(_h, j)')} + {k}) <> get(words, {place('get(_h, j - 1)')} + {k})" for k in range(3))
    short = "array_compact(cast(array() as array<bigint>))"
    places = (
        words.withColumn("_k", F.expr(f"if(size(words) < 4, {short}, sort_array(transform(sequence(0, size(words) - 3), i -> (xxhash64(words[i], words[i + 1], words[i + 2]) & {-(1 << PLACE_BITS)}L) | cast(i as bigint))))"))
        .withColumn("_h", F.expr(f"filter(_k, (x, j) -> {same('x', 'get(_k, j - 1)')} or {same('x', 'get(_k, j + 1)')})"))
        .withColumn("_odd", F.expr(f"size(words) > {1 << PLACE_BITS} or exists(if(size(_h) < 2, array(), sequence(1, size(_h) - 1)), j -> {same('get(_h, j)', 'get(_h, j - 1)')} and ({differ}))"))
        .withColumn("_w", F.expr(f"if(coalesce(_odd, false), {windows}, null)"))
        .withColumn("_p", F.expr(f"array_sort(if(coalesce(_odd, false), transform({exact}, x -> x.i), transform(_h, x -> {place('x')})))"))
        .drop("_k", "_h", "_odd", "_w")
    )
    # each window covers three words or up to the next window
    repeat = F.expr("aggregate(_p, named_struct('n', 0L, 'end', 0), (a, i) -> named_struct('n', a.n + (i + 3 - greatest(i, a.end)), 'end', i + 3), a -> a.n)")
    lines = F.expr(f"filter(split(text, '\\n'), x -> length({_without('x', SPACES)}) > 0)")
    counted = places.withColumn("_l", lines).select(
        "doc_id",
        "text",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.expr(f"cast(length({_without('text', SPACES)}) as bigint)").alias("word_chars"),
        F.expr(f"cast(length(text) - length({_without('text', '#*$%&|<>')}) as bigint)").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def ratio(weight: tuple[list[float], list[float]] | Column, n: int | None = None) -> Column:
    """Mean log-ratio over the n-grams of ``words`` by the weights of ``fold``, or by a column with the row's own ``n`` weights; null without words."""
    if not isinstance(weight, Column):
        first, second = (F.split(F.lit(",".join(map(repr, w))), ",").cast("array<double>") for w in weight)
        weight, n = F.when(F.col("fold") == 0, first).otherwise(second), len(weight[0])

    def total_by(held: Column) -> Column:
        def add(total: Column, i: Column) -> Column:
            word, following = F.get("words", i), F.get("words", i + 1)
            one = F.get(held, F.pmod(F.xxhash64(word), F.lit(n)).cast("int"))
            two = F.get(held, F.pmod(F.xxhash64(word, following), F.lit(n)).cast("int"))
            return total + one + F.when(following.isNull(), F.lit(0.0)).otherwise(two)

        return F.aggregate(F.sequence(F.lit(0), F.size("words") - 1), F.lit(0.0), add)

    # the fold's weights are looked up once a text
    total = F.get(F.transform(F.array(weight), total_by), F.lit(0))
    return F.when(F.size("words") > 0, total / (2 * F.size("words") - 1))


def with_ratio(words: DataFrame, weight: tuple[list[float], list[float]]) -> DataFrame:
    """Add ``ratio`` to rows with ``text`` and ``words``.

    The weights are a subquery's value, so they are no part of the plan's text, of which the driver keeps many copies.
    """
    both = words.sparkSession.createDataFrame([(list(weight),)], "weights array<array<double>>").scalar()
    # read in one place alone, so that the row never holds them
    return words.withColumn("_weights", F.get(both, fold())).withColumn("ratio", ratio(F.col("_weights"), len(weight[0]))).drop("_weights")


def threshold(texts: DataFrame, weight: tuple[list[float], list[float]], lost: float = LOST) -> float:
    """The ratio under which a share ``lost`` of the texts with words falls, rounded down; 0 if there is none."""
    words = with_words(texts.select(F.lit(0).alias("doc_id"), "text"))
    ratios = with_ratio(words, weight).select(F.inline_outer(F.array(F.struct("ratio"))))
    scored = ratios.where("ratio is not null").select(F.floor(F.col("ratio") * STEPS).alias("step"))
    # ratios lie between the logarithms of the counts: some ten thousand steps at most
    steps = sorted((r.step, r.n) for r in scored.groupBy("step").agg(F.count("*").alias("n")).collect())
    left = lost * sum(n for _, n in steps)
    for step, n in steps:
        left -= n
        if left < 0:
            return step / STEPS
    return 0.0


def judge(docs: DataFrame, trusted: DataFrame, trusted_rows: int, buckets: int = BUCKETS, lost: float = LOST, at: float | None = None) -> DataFrame:
    """Base counts, ``ratio`` and ``kept`` of every row of ``docs``; ``at`` sets the threshold by hand."""
    weight = weights(bucket_counts(docs, trusted, trusted_rows, buckets), buckets)
    at = threshold(trusted_texts(docs, trusted, trusted_rows), weight, lost) if at is None else at
    judged = with_ratio(base_rules(with_words(docs)), weight).drop("words", "text")
    judged = judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("ratio") >= at, F.lit(False)))
    # the outer form: the other has a filter on its input, which would be pushed below and computed twice
    return judged.select(F.inline_outer(F.array(F.struct(*judged.columns))))


def op7(spark, sf_dir: str) -> DataFrame:
    """Base rules and log-likelihood ratio of all ``documents``; trusted: labelled of good quality."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return judge(table(spark, sf_dir, "documents", spread=True), trusted, trusted.count()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio"
    )
