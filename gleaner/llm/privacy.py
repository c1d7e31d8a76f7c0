"""Personal data: patterns, and terms that give it away by corpus co-occurrence. SQL functions only."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm import spans as S
from gleaner.operators.skew import skew_join
from gleaner.session import written

KINDS = ("email", "ip", "card", "phone")
#: Runs are matched from their start or from the last match's end and never given back: same matches, linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
FILTER_BITS = 1 << 20  # of the filter of telling terms; with more of them it only lets more through
TERM = r"\p{L}[\p{L}'-]+\p{L}"  # quotation marks and dashes around a word are no part of it


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Check sum: from the right every second digit counts double, less 9 from 10 on."""
    digits = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d: d.cast("int"))
    parts = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(parts, F.lit(0), lambda acc, p: acc + p) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each kind, failing matches dropped. Texts must not be null."""
    low = lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
    small = lambda s: F.forall(F.split(F.regexp_replace(s["value"], r"(?<![0-9])0+(?=[0-9])", ""), r"\."), low)
    n_digits = lambda s: F.length(_digits(s["value"]))
    return {
        "email": S.when(F.contains(text, F.lit("@")), S.found(text, EMAIL)),
        "ip": F.filter(S.when(F.rlike(text, F.lit(r"[0-9]\.[0-9]+\.[0-9]")), S.found(text, IP)), small),
        "card": F.filter(S.when(F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){12}")), S.found(text, CARD)), lambda s: _luhn(s["value"])),
        "phone": F.filter(S.when(F.contains(text, F.lit("+")), S.found(text, PHONE)), lambda s: n_digits(s).between(9, 15)),
    }


def _of(make, kind: str):
    return lambda s: make(kind, s)


def _entity(kind: str, s: Column) -> Column:
    value = s["value"]
    return F.concat(F.lit(kind + ":"), F.lower(value) if kind in ("email", "ip") else _digits(value))


def _terms(text: Column, spans: Column) -> Column:
    """Distinct lower-cased terms of a text outside its spans."""
    every = F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower)
    beside = F.transform(S.outside(S.places(text, TERM, lambda value: value.isNotNull()), spans), lambda p: p["value"])
    return F.array_distinct(F.when(F.size(spans) > 0, beside).otherwise(every))


def _likely(words: Column, term: Column) -> Column:
    """Whether a term is in the filter."""
    spot = F.pmod(F.xxhash64(term), F.lit(FILTER_BITS))
    return F.getbit(F.get(words, F.shiftright(spot, 6).cast("int")), spot.bitwiseAND(F.lit(63)).cast("int")) == 1


def _likely_places(text: Column, spans: Column, words: Column) -> Column:
    """Places of the terms that the filter lets through and that meet no span. Positions are found only in texts that hold
    such a term at all."""
    def of(x: Column) -> Column:
        every = F.regexp_extract_all(x["t"], F.lit(TERM), F.lit(0))
        held = F.exists(every, lambda value: _likely(x["w"], F.lower(value)))
        found = S.places(x["t"], TERM, lambda value: _likely(x["w"], value))
        return F.when(held, F.when(F.size(x["s"]) > 0, S.outside(found, x["s"])).otherwise(found))

    bound = F.struct(text.alias("t"), spans.alias("s"), words.alias("w"))
    return F.transform(F.array(bound), of)[0]


def _bits(terms: DataFrame) -> Column:
    """The terms as bits of a filter of ``FILTER_BITS``, 64 to a word: a constant of that size, whatever the number of terms."""
    spot = terms.select(F.pmod(F.xxhash64("term"), F.lit(FILTER_BITS)).alias("p"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
    words = [0] * -(-FILTER_BITS // 64)
    for r in spot.groupBy(F.shiftright("p", 6).alias("at")).agg(F.bit_or(one).alias("word")).collect():  # at most len(words)
        words[r["at"]] = r["word"]
    return F.from_json(F.lit(json.dumps(words)), "array<bigint>")


def _marks(rows: DataFrame, telling: DataFrame, counts: DataFrame) -> DataFrame:
    """``_row, terms``: every place of a telling term in a row that has any.

    Places are tested where the texts lie, against a filter of fixed size that misses no telling term; what passes meets
    the terms by key. No text is shuffled.
    """
    places = rows.select("_row", F.explode(_likely_places(F.col("_t"), F.col("_ends"), _bits(telling))).alias("p"))
    likely = places.select("_row", "p.start", "p.end", F.col("p.value").alias("term"))
    hits = skew_join(likely, telling, "term", counts=counts)
    listed = F.array_sort(F.collect_list(F.struct("start", "end", "mark")))  # as many as a text has words
    return hits.groupBy("_row").agg(listed.alias("terms"))


def _classes(held: DataFrame) -> DataFrame:
    """``_row, class, with_entity`` of ``_row, entity, with_entity``: entities in the very same rows are one class.

    Whatever co-occurs with one of them does so with all. A page that lists thousands of addresses and its copies hold
    one class. Row sets are compared by size and two independent 64-bit sums.
    """
    one, two = F.xxhash64("_row"), F.xxhash64(F.lit(25), "_row", F.lit(7))
    prints = held.groupBy("entity", "with_entity").agg(F.bit_xor(one).alias("p1"), F.sum(two.cast("decimal(20,0)")).alias("p2"))
    first = written(prints.groupBy("with_entity", "p1", "p2").agg(F.min("entity").alias("entity")).select("entity"), "classes")
    size = held.join(first, "entity", "left_semi").groupBy("entity").agg(F.count("*").alias("_n"))
    return skew_join(held, first, "entity", "left_semi", counts=size).withColumnRenamed("entity", "class")


def find_personal(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    disclosure: float = 0.8,
    removal: float = 0.95,
    support: int = 3,
) -> DataFrame:
    """Per row: id, the spans of each kind (``email ip card phone``: start, end, value ...) and ``terms`` (start, end, mark).

    An entity (the same address or number anywhere) is disclosed by a term when PMI(entity; term) over the information of
    the entity, that is 1 + log p(entity | term) / -log p(entity), reaches ``disclosure``; p is the share of rows, and the two
    must meet in ``support`` rows, anywhere in their texts; a term that meets a span is none. Every occurrence of such a
    term in any row gets the mark ``[TERM]``, from ``removal`` on none (they go). Terms are counted over all rows once a row,
    combined before the shuffle; those that cannot reach the ratio with an entity, however often they meet, go before pairs
    are made, and entities of the same rows are paired as one. Hot entities and terms stay sums.

    Null texts are empty and have no spans; repeated rows count as rows of their own; an empty table gives no rows; columns
    but the two named are not read. Time is linear in a text and its spans. The scan is a written table, which the texts
    never leave: only terms, places and spans are shuffled.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("_id"), text.alias("_t"))
    scanned = source.select("_id", "_t", *(x.alias(k) for k, x in base_spans(F.col("_t")).items()))
    ends = F.concat(*(F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in KINDS))
    rows = written(scanned.withColumns({"_ends": ends, "_row": F.monotonically_increasing_id()}), "personal")
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint,mark:string>>)")
    narrow = rows.select("_row", F.col("_id").alias(id_col), *KINDS)
    n = rows.count()
    information = -F.log(F.greatest(F.col("with_entity"), F.lit(1)) / F.lit(float(max(n, 1) + 1)))
    ratio = lambda both: 1 + F.log(both / F.col("with_term")) / information
    within_reach = ratio(F.least("with_term", "with_entity")) >= disclosure - 1e-9
    named = F.array_distinct(F.concat(*(F.transform(k, _of(_entity, k)) for k in KINDS)))
    holding = rows.filter(F.size("_ends") > 0).select("_row", F.explode(named).alias("entity"))
    entities = written(holding.groupBy("entity").agg(F.count("*").alias("with_entity")).filter(F.col("with_entity") >= support), "entities")
    most = entities.agg(F.max("with_entity").alias("n")).first()["n"] or 0
    if not most:  # nobody to disclose
        return narrow.select(id_col, *KINDS, none.alias("terms"))
    listed = F.explode(_terms(F.col("_t"), F.col("_ends"))).alias("term")
    counted = rows.select(listed).groupBy("term").agg(F.count("*").alias("with_term")).filter(F.col("with_term") >= support)
    terms = written(counted.withColumn("with_entity", F.lit(most)).filter(within_reach).drop("with_entity"), "terms")
    held = written(skew_join(holding, entities, "entity", counts=entities.withColumnRenamed("with_entity", "_n")), "held")
    classes = written(_classes(held), "class-rows")
    beside = rows.select("_row", "_t", "_ends").join(classes.select("_row").distinct(), "_row", "left_semi").select("_row", listed)
    near = skew_join(beside, terms, "term", counts=terms.withColumnRenamed("with_term", "_n"))
    pairs = classes.join(near, "_row").filter(within_reach).groupBy("class", "term", "with_entity", "with_term").agg(F.count("*").alias("both"))
    told = pairs.filter(F.col("both") >= support).withColumn("ratio", ratio(F.col("both"))).filter(F.col("ratio") >= disclosure)
    mark = F.when(F.col("ratio") >= removal, "").otherwise("[TERM]")
    telling = written(told.groupBy("term").agg(F.min(mark).alias("mark")), "telling")
    if telling.isEmpty():
        return narrow.select(id_col, *KINDS, none.alias("terms"))
    counts = telling.join(terms, "term").select("term", F.col("with_term").alias("_n"))
    marks = written(_marks(rows, telling, counts), "marks")
    return narrow.join(marks, "_row", "left").select(id_col, *KINDS, F.coalesce("terms", none).alias("terms"))


def _mark(kind: str, s: Column) -> Column:
    return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{kind.upper()}]").alias("mark"))


def sanitised(text: Column) -> Column:
    """The text of a row of ``find_personal`` (joined back by the caller) without its personal data: kinds in brackets, terms
    generalised or removed."""
    marks = [F.transform(k, _of(_mark, k)) for k in KINDS]
    return S.replaced(F.coalesce(text, F.lit("")), F.concat(*marks, F.col("terms")))
