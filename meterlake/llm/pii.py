r"""Sanitising personal data by what terms reveal.

The protected entities are the personal data found by patterns (mail and IP
addresses, card and phone numbers). The corpus tells how strongly other terms
reveal them: a term that stands near an entity in at least two different
contexts, and that hardly occurs without it, discloses the entity. Disclosure
is the pointwise mutual information of term and entity as a share of the
entity's information content:

    PMI(t, e) = log2(n(t, e) N / (n(t) n(e)))      IC(e) = log2(N / n(e))

with n counting documents, n(t, e) those where the term stands near the
entity. It is 1 if the term never occurs without the entity. Terms from
GENERALISE on are generalised, those from REMOVE on are removed, at every
place of every text, near the entity or not. Everything is built-in functions; texts stay where they are, only
the found spans and their surroundings are exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.keyed import skew_join
from meterlake.llm.common import row_ref, stored

KINDS = ("email", "ip", "card", "phone", "generalise", "remove")
BASE = 4
# Each pattern says what the plain one says, but can only start where that one
# would (at the start of a run, or where the last match ended) and never goes
# back into a run, so that no text takes more than linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this has no valid match.
NEEDED = {
    "email": "instr(_text, '@') > 0",
    "ip": r"_text rlike '[0-9]\\.[0-9]++\\.[0-9]'",
    "card": r"_text rlike '[0-9](?:[\\x20-]?[0-9]){11}'",
    "phone": "instr(_text, '+') > 0",
}
DIGITS = r"regexp_replace(value, '[^0-9]', '')"
VALID = {
    "email": "true",
    "ip": r"forall(split(value, '\\.'), x -> coalesce(try_cast(regexp_replace(x, '^0+(?=.)', '') AS int) <= 255, false))",
    "card": f"length({DIGITS}) BETWEEN 12 AND 19 AND luhn_check({DIGITS})",
    "phone": f"length({DIGITS}) BETWEEN 9 AND 15",
}
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalise": "[TERM]", "remove": ""}
CONTEXT = 80
TERM_LENGTH = 3
MARK_BITS = 22  # words are looked up in a map of 2^22 term hashes (512 KB) before the join
GENERALISE = 0.8
REMOVE = 0.95


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Valid base spans: rid, rhash, kind (position in KINDS), value, start, end, before, after.

    before and after are up to CONTEXT characters around. The place of a match
    is the length of all gaps and matches before it, which a window over the
    matches of one document and kind adds up; repeated rows are one document.
    """
    ref = row_ref(id_col, text_col)
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"), ref.alias("_ref"))
    found = []
    for number, kind in enumerate(KINDS[:BASE]):
        pattern = _literal(PATTERNS[kind])
        found.append(
            f"CASE WHEN {NEEDED[kind]} THEN transform(array(struct(regexp_extract_all(_text, {pattern}, 0) AS m,"
            f" split(_text, {pattern}, -1) AS g)), f -> transform(f.m, (v, i) -> struct({number} AS kind, i AS i, v AS value,"
            f" length(f.g[i]) AS gap, right(f.g[i], {CONTEXT}) AS before, left(f.g[i + 1], {CONTEXT}) AS after)))[0] END"
        )
    none = "cast(array() AS array<struct<kind: int, i: int, value: string, gap: int, before: string, after: string>>)"
    every = F.expr("concat(" + ", ".join(f"coalesce({x}, {none})" for x in found) + ")")
    matches = rows.select("_ref.id", "_ref.hash", F.inline(every)).withColumnsRenamed({"id": "rid", "hash": "rhash"}).distinct()
    order = Window.partitionBy("rid", "rhash", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.length("value")).cast("long")).over(order)
    placed = matches.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    valid = " OR ".join(f"(kind = {n} AND {VALID[k]})" for n, k in enumerate(KINDS[:BASE]))
    return placed.where(valid).select("rid", "rhash", "kind", "value", "start", "end", "before", "after")


def _terms_of(side: str, offset: str, whole: str) -> str:
    """Words (letters) of one side of a span, as structs of term, start, end; the one that may be cut is left out."""
    pieces = f"split({side}, '[^\\\\p{{L}}]', -1)"
    place = "aggregate(slice(p, 1, i), 0, (a, x) -> a + length(x) + 1)"
    words = f"transform(array({pieces}), p -> transform(p, (w, i) -> struct(lower(w) AS term, {offset} + {place} AS start, {offset} + {place} + length(w) AS end, {whole} AS whole)))[0]"
    return f"filter({words}, x -> x.whole AND length(x.term) >= {TERM_LENGTH})"


def neighbours(found: DataFrame) -> DataFrame:
    """rid, rhash, entity, term, context, start, end for every word near an entity."""
    full = f"length({{}}) = {CONTEXT}"
    before = _terms_of("before", "start - length(before)", f"(i > 0 OR NOT {full.format('before')})")
    after = _terms_of("after", "end", f"(i < size(p) - 1 OR NOT {full.format('after')})")
    rows = found.select(
        "rid",
        "rhash",
        F.concat_ws(":", F.col("kind"), F.lower("value")).alias("entity"),
        F.xxhash64("before", "after").alias("context"),
        F.inline(F.expr(f"concat({before}, {after})")),
    )
    return rows.drop("whole")


def disclosing(docs: DataFrame, near: DataFrame, text_col: str = "text") -> DataFrame:
    """(entity, term, disclosure) from GENERALISE on.

    Copies of one context don't make a term revealing: two different ones are needed.
    """
    once = near.groupBy("entity", "term", "rid", "rhash").agg(F.min("context").alias("a"), F.max("context").alias("b"))
    pairs = once.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.min("a").alias("a"), F.max("b").alias("b"))
    pairs = pairs.where("a <> b").select("entity", "term", "n_both")
    by_entity = near.select("entity", "rid", "rhash").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}]+"))
    by_term = docs.select(F.explode(words).alias("term")).where(F.length("term") >= TERM_LENGTH)
    by_term = by_term.groupBy("term").agg(F.count("*").alias("n_term"))
    every = docs.agg(F.count("*").alias("n")).scalar()
    joined = skew_join(pairs, by_entity, ["entity"], "inner")
    joined = skew_join(joined, by_term, ["term"], "inner").withColumn("n", every)
    content = F.log2(F.col("n") / F.col("n_entity"))
    shared = F.log2(F.col("n_both") * F.col("n") / (F.col("n_term") * F.col("n_entity")))
    # An entity that is in every document has no content to disclose.
    share = F.when(content > 0, shared / content)
    return joined.select("entity", "term", share.alias("disclosure")).where(F.col("disclosure") >= GENERALISE)


def occurrences(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rid, rhash, kind, start, end of every place of the terms (term, kind; no repeats) in the texts.

    Words that can be no term are dropped before the exchange, by a map of the
    terms' hashes whose size is fixed; the join by term drops the rest. Places
    are added up from gaps between the words that stay, as in entities().
    """
    marks = terms.select(F.xxhash64("term").alias("h"))
    marks = marks.select(F.shiftrightunsigned("h", 70 - MARK_BITS).alias("word"), F.expr("shiftleft(1L, cast(h & 63L AS int))").alias("bit"))
    marks = marks.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = docs.sparkSession.range(1 << (MARK_BITS - 6)).withColumnRenamed("id", "word")
    marks = every.join(marks, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    marks = marks.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("m")).select("m.bits").scalar()
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"), row_ref(id_col, text_col).alias("_ref"), marks.alias("_marks"))
    h = "xxhash64(lower(p[i]))"
    marked = f"shiftrightunsigned(get(_marks, cast(shiftrightunsigned({h}, {70 - MARK_BITS}) AS int)), cast({h} & 63L AS int)) & 1L = 1L"
    last = "coalesce(get(at, j - 1), 0)"
    gap = f"aggregate(slice(p, {last} + 1, i - {last}), 0, (a, x) -> a + length(x) + 1)"
    words = (
        r"transform(array(split(_text, '[^\\p{L}]', -1)), p -> transform(array("
        f"filter(sequence(0, size(p) - 1), i -> length(p[i]) >= {TERM_LENGTH} AND {marked})), at -> transform(at, (i, j) ->"
        f" struct(j AS i, lower(p[i]) AS term, length(p[i]) AS size, {gap} AS gap)))[0])[0]"
    )
    found = rows.select("_ref.id", "_ref.hash", F.inline(F.expr(words))).withColumnsRenamed({"id": "rid", "hash": "rhash"}).distinct()
    order = Window.partitionBy("rid", "rhash").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("start", F.sum(F.col("gap").cast("long")).over(order))
    found = found.select("rid", "rhash", "term", "start", (F.col("start") + F.col("size")).alias("end"))
    return skew_join(found, terms, ["term"], "inner").select("rid", "rhash", "kind", "start", "end")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All spans: rid, rhash, kind, start, end, covered (the end of what earlier spans cover).

    Base spans stay as the patterns give them; a term that touches one is left
    to it. Texts without personal data and disclosing terms have no row.
    """
    found = stored(entities(docs, id_col, text_col), "entities")
    near = stored(neighbours(found), "near")
    kind = F.when(F.col("disclosure") >= REMOVE, KINDS.index("remove")).otherwise(KINDS.index("generalise"))
    told = disclosing(docs, near, text_col).groupBy("term").agg(F.max(kind).alias("kind"))
    told = stored(told, "disclosing")
    columns = ["rid", "rhash", "kind", "start", "end"]
    # A word that a base span cuts off is found near it only.
    terms = skew_join(near, told, ["term"], "inner").select(*columns)
    terms = terms.unionByName(occurrences(docs, told, id_col, text_col))
    terms = terms.groupBy("rid", "rhash", "start", "end").agg(F.max("kind").alias("kind"))
    every = found.select(*columns).unionByName(terms.select(*columns))
    order = Window.partitionBy("rid", "rhash").orderBy("start", "kind")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(1, Window.unboundedFollowing)
    base = F.col("kind") < BASE
    every = every.withColumns({
        "_left": F.max(F.when(base, F.col("end"))).over(earlier),
        "_right": F.min(F.when(base, F.col("start"))).over(later),
    })
    clear = (F.coalesce("_left", F.lit(0)) <= F.col("start")) & (F.coalesce("_right", F.col("end")) >= F.col("end"))
    kept = every.where(base | clear).drop("_left", "_right")
    return kept.withColumn("covered", F.coalesce(F.max("end").over(earlier), F.lit(0)))


def _name(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), kind + 1)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """docs as the struct column `row`, with spans and (if asked for) the sanitised text `clean`.

    spans is an array of (start, kind, end, name), by start and kind, in code
    points; clean has a mark for every span, or nothing for a removed term. A
    null text counts as empty and stays null in clean. Repeated rows get equal results;
    names of other columns can't clash, because they stay in `row`.
    """
    found = spans(docs, id_col, text_col)
    entry = F.struct("start", "kind", "end", _name(F.col("kind")).alias("name"), "covered")
    lists = found.groupBy("rid", "rhash").agg(F.array_sort(F.collect_list(entry)).alias("spans"))
    ref = row_ref(id_col, text_col)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if with_text else F.struct(id_col)
    rows = docs.select(row.alias("row"), ref.alias("_ref")).select("row", "_ref.id", "_ref.hash")
    rows = rows.withColumnsRenamed({"id": "rid", "hash": "rhash"})
    out = skew_join(rows, lists, ["rid", "rhash"], "left")
    plain = "transform(coalesce(spans, array()), s -> struct(s.start, s.kind, s.end, s.name))"
    out = out.select("row", F.expr(plain).alias("spans"), F.col("spans").alias("_all"))
    if not with_text:
        return out.drop("_all")
    marks = "map(" + ", ".join(f"'{k}', '{m}'" for k, m in MASKS.items()) + ")"
    text = f"row.`{text_col}`"
    # What lies between what is covered and this span, then the span's mark, unless it is covered already.
    part = (
        f"concat(CASE WHEN s.start > s.covered THEN substring({text}, cast(s.covered AS int) + 1, cast(s.start - s.covered AS int)) ELSE '' END,"
        f" CASE WHEN s.start >= s.covered THEN {marks}[s.name] ELSE '' END)"
    )
    rest = f"substring({text}, cast(array_max(transform(_all, s -> s.end)) AS int) + 1)"
    clean = f"CASE WHEN _all IS NULL THEN {text} ELSE concat(array_join(transform(_all, s -> {part}), ''), {rest}) END"
    return out.select("row", "spans", F.expr(clean).alias("clean"))


def listing(array: str, base_only: bool = False) -> Column:
    """The spans as kind:start:end, joined by commas."""
    chosen = f"filter({array}, s -> s.kind < {BASE})" if base_only else array
    return F.expr(f"array_join(transform({chosen}, s -> concat_ws(':', s.name, s.start, s.end)), ',')")
