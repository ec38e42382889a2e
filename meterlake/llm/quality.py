"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the corpus.

Words and word pairs of a document are hashed into a fixed number of buckets.
Two multinomials over the buckets are counted: one over trusted documents (a
bounded sample of the labelled ones) and one over all documents. A document's
score is the mean log ratio of its n-grams, and documents under a fixed score
are rejected. All of it is built-in functions; the two count tables have a
fixed number of buckets, so the scores of any corpus come from one small array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_SPLIT = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
BUCKETS = 1 << 14
PRIOR = 8 * BUCKETS  # weight, in n-grams, of the corpus in the trusted multinomial
TRUSTED_DOCS = 20_000
THRESHOLD = -0.05
MIN_WORDS = 50
# A packed trigram: 40 bits of hash above 24 bits of position.
POSITION_BITS = 24
POSITIONS = 1 << POSITION_BITS


def _words(text: str) -> Column:
    return F.expr(rf"array_remove(split({text}, '[\\x20\\x09-\\x0D]+'), '')")


def _grams(buckets: int) -> Column:
    """Buckets of words and word pairs, from the word hashes _h."""
    mask = buckets - 1
    rest = "greatest(size(_h) - 1, 0)"
    return F.expr(
        f"concat(transform(_h, x -> cast(x & {mask}L AS int)),"
        f" zip_with(slice(_h, 1, {rest}), slice(_h, 2, {rest}), (x, y) -> cast(xxhash64(x, y) & {mask}L AS int)))"
    )


def _hashed(docs: DataFrame, text_col: str, **kept: Column) -> DataFrame:
    """kept columns, _text, _words and _h (a hash per word)."""
    rows = docs.select(*[c.alias(name) for name, c in kept.items()], F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_words", _words("_text"))
    return rows.withColumn("_h", F.expr("transform(_words, w -> xxhash64(w))"))


def trusted_ids(labels: DataFrame, at_most: int = TRUSTED_DOCS) -> DataFrame:
    """Ids of the trusted sample: good and not toxic, the at_most with the smallest hash."""
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """One row with `ratios`, the log ratio of every bucket.

    trusted holds ids (bounded by trusted_ids) and is broadcast. The trusted
    multinomial has the corpus as its prior, so without trusted text every
    ratio is 0.
    """
    marks = F.broadcast(trusted.select(F.col("doc_id").alias("_id"), F.lit(1).alias("_trusted")))
    rows = _hashed(docs, text_col, _id=F.col(id_col)).join(marks, "_id", "left")
    grams = rows.select(F.coalesce("_trusted", F.lit(0)).alias("_trusted"), F.explode(_grams(buckets)).alias("_bucket"))
    counts = grams.groupBy("_bucket").agg(F.count("*").alias("_all"), F.sum("_trusted").alias("_good"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("_bucket"))
    counts = every.join(counts, "_bucket", "left").fillna(0)
    # A fixed number of rows: one per bucket.
    whole = counts.agg(
        F.array_sort(F.collect_list(F.struct("_bucket", "_all", "_good"))).alias("c"),
        F.sum("_all").alias("n_all"),
        F.sum("_good").alias("n_good"),
    )
    whole = whole.withColumn("p", F.expr(f"transform(c, x -> (x._all + 1D) / (n_all + {buckets}D))"))
    ratio = f"transform(c, (x, i) -> ln((x._good + {PRIOR}D * p[i]) / (n_good + {PRIOR}D)) - ln(p[i]))"
    return whole.select(F.expr(f"CASE WHEN size(p) > 0 THEN {ratio} END").alias("ratios"))


def _repeat_words() -> str:
    """Words in three-word windows that occur twice or more, from the sorted packed trigrams _s.

    Neighbours with the same hash bits are one window; the words are compared
    too, and if a comparison ever fails, the words themselves are sorted.
    """
    same = f"coalesce(shiftrightunsigned(s ^ get(_s, {{}}), {POSITION_BITS}) = 0, false)"
    at = f"cast({{}} & {POSITIONS - 1}L AS int)"
    here, there = at.format("s"), at.format("get(_s, k - 1)")
    differ = " OR ".join(f"_words[{here} + {d}] <> _words[{there} + {d}]" for d in range(3))
    clash = f"size(_t) > {POSITIONS} OR size(filter(_s, (s, k) -> {same.format('k - 1')} AND ({differ}))) > 0"
    quick = f"transform(filter(_s, (s, k) -> {same.format('k - 1')} OR {same.format('k + 1')}), s -> {here})"
    windows = "sort_array(transform(_t, (t, i) -> struct(_words[i] AS a, _words[i + 1] AS b, _words[i + 2] AS c, i AS p)))"
    equal = "coalesce(struct(z.a, z.b, z.c) = struct(get(zs, {0}).a, get(zs, {0}).b, get(zs, {0}).c) AND get(zs, {0}) IS NOT NULL, false)"
    sure = (
        f"transform(array({windows}), zs -> transform(filter(zs, (z, k) -> {equal.format('k - 1')} OR"
        f" {equal.format('k + 1')}), z -> z.p))[0]"
    )
    covered = "aggregate(transform(qs, (q, k) -> coalesce(least(3, get(qs, k + 1) - q), 3)), 0, (a, x) -> a + x)"
    count = f"transform(array(sort_array({{}})), qs -> {covered})[0]"
    return (
        f"CASE WHEN size(_s) = 0 AND size(_t) <= {POSITIONS} THEN 0 WHEN {clash} THEN {count.format(sure)}"
        f" ELSE {count.format(quick)} END"
    )


def assess(docs: DataFrame, ratios: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs as the struct column `row`, with the struct column `quality`.

    quality: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    score, base_failed, kept. A null text counts as empty and fails for having
    too few words; so does any text without words, whose score is 0. Equal
    texts get equal results. Names of other columns can't clash, because they
    stay inside `row`. ratios is the one row of log_ratios.
    """
    rows = _hashed(docs, text_col, row=F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    rows = rows.withColumn("_t", F.expr("transform(slice(_h, 3, greatest(size(_h) - 2, 0)), (x, i) -> xxhash64(_h[i], _h[i + 1], x))"))
    packed = f"transform(_t, (t, i) -> (t & {-POSITIONS}L) | i)"
    rows = rows.withColumns({
        "_s": F.expr(f"CASE WHEN size(_t) <= {POSITIONS} AND size(array_distinct(_t)) < size(_t) THEN sort_array({packed}) ELSE array() END"),
        "_g": _grams(BUCKETS),
        "_lines": F.expr(r"filter(split(_text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"),
        "_ratios": ratios.scalar(),
    })
    n = F.size("_words")
    # A filter on the verdict must not be moved into these expressions, where it
    # would repeat them; the random number, which is never used, holds it back.
    mean = F.expr("CASE WHEN size(_g) = 0 THEN 0D ELSE aggregate(_g, 0D, (a, b) -> a + _ratios[b]) / size(_g) END")
    rows = rows.select(
        "row",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(_repeat_words()).cast("long").alias("n_repeat_words"),
        F.coalesce(mean, F.rand(0)).alias("score"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    kept = ~failed & (F.col("score") >= threshold)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]
    return rows.select("row", F.struct(*names, failed.alias("base_failed"), kept.alias("kept")).alias("quality"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """assess with the ratios of docs itself and the trusted documents of labels."""
    return assess(docs, log_ratios(docs, trusted_ids(labels), id_col, text_col), text_col)
