"""Registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import (
    language, leaks, licenses, mixing, pages, privacy, repetition, runs, search, secrets, simhash, tokens, toxicity,
)
from gleaner.llm import spans as S
from gleaner.llm.common import crc_fold
from gleaner.session import table


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_output(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.find_personal(table(spark, sf_dir, "documents"))
    base = [(k, F.col(k)) for k in privacy.KINDS]
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in privacy.KINDS),
        F.sha2(S.listed(base), 256).alias("base_sha256"), S.listed([*base, ("term", F.col("terms"))]).alias("spans"),
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = [(k, F.col(k)) for k in secrets.KINDS]
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in secrets.KINDS),
        F.sha2(S.listed(base, by_start=True), 256).alias("base_sha256"),
        S.listed([*base, ("random", F.col("random"))], by_start=True).alias("spans"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = (crc_fold(F.col("doc_id")) == 1).alias("held_out")
    return toxicity.toxicity(docs, model).select("doc_id", held_out, "score", "predicted")


def op7_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = (crc_fold(F.col("doc_id")) == 1).alias("held_out")
    return language.language_id(table(spark, sf_dir, "documents")).select("doc_id", held_out, "lang_pred", "score")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    rows = mixed.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source")


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(runs.looped(table(spark, sf_dir, "documents")))
    best = runs.strongest("runs")
    line = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(line, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    base, more = F.array_distinct("places.label"), F.array_distinct("spans.label")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"), "score",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (
        op1_simhash, op2_decontamination, op3_tokens, op4_pii, op5_secrets, op6_toxicity, op7_extraction, op8_language,
        op9_mixing, op10_repetition, op11_periodic_runs, op12_ranked_search, op13_licenses,
    )
    return {f.__name__: f for f in listed}


#: Words of a lower-cased text as the leak query cuts them.
_LEAK_WORDS = r"""regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_LEAKS = f"""
with d as (select row_number() over () r, doc_id, {_LEAK_WORDS.format(t="text")} w from documents),
b as (select cast(item_id as varchar) item, {_LEAK_WORDS.format(t="text")} w from benchmark),
bw as (select distinct item, least(10, len(w)) n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') win
  from (select item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) i from b where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (select r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') win
  from (select r, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) i from d, sizes)),
hit as (select r, i, dw.n, item from dw join bw on dw.n = bw.n and dw.win = bw.win),
pos as (select r, count(distinct p) n_hit from (select r, unnest(range(i, i + n)) p from hit) group by r),
its as (select r, count(distinct item) n_items, array_to_string(list_sort(list(distinct item)), ',') items from hit group by r)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join pos using (r) left join its using (r)"""

_WINDOWS = """
{name} as (select r, i from (select r, i, count(*) over (partition by r, win) c
  from (select r, i, md5(array_to_string(list_slice(w, i, i + {n} - 1), ' ')) win
    from (select r, w, unnest(range(1, greatest(len(w) - {n} + 2, 1))) i from d))) where c > 1)"""

_REPETITION = rf"""
with d as (select row_number() over () r, doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
{_WINDOWS.format(name="w3", n=3)},
{_WINDOWS.format(name="w8", n=8)},
wl as (select r from (select r, md5(array_to_string(list_slice(w, i, i + n - 1), ' ')) win from (
  select r, w, n, unnest(range(1, len(w) - n + 2)) i from (select r, w, 15 * len(w) // 100 + 1 n from d where len(w) >= 50)))
  group by r, win having count(*) > 1),
p3 as (select r, count(distinct p) n from (select r, unnest(range(i, i + 3)) p from w3) group by r),
p8 as (select r, count(distinct p) n from (select r, unnest(range(i, i + 8)) p from w8) group by r),
lines as (select r, count(*) - count(distinct l) n from (select r, unnest(string_split(t, chr(10))) l from d)
  where regexp_matches(l, '[^\x20\x09-\x0D]') group by r),
m as (select doc_id, cast(len(w) as bigint) n_words, cast(length(array_to_string(w, '')) as bigint) word_chars,
  cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) n_symbols,
  coalesce(lines.n, 0) n_dup_lines, coalesce(p3.n, 0) n_repeat_words, coalesce(p8.n, 0) covered, r in (select r from wl) long
  from d left join lines using (r) left join p3 using (r) left join p8 using (r)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and 10 * covered <= 3 * n_words and not long kept from f"""


#: crc32 of the decimal doc_id, byte by byte and bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''),
    lambda c: ord(c)::bigint)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
    lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)))"""

_RUNS = rf"""
with o as (select row_number() over () r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w,
  case when doc_id is null then 1 else {_CRC} end h from documents),
s as (select *, len(w) n, h // 10 g from o),
a as (select *, g % n a, 1 + (n - g % n) // (3 + g % 8) p from s where h % 10 = 0 and n > 0),
d as (select r, doc_id, w from s where h % 10 <> 0 or n = 0
  union all select r, doc_id, list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % p end]) from a),
x as (select r, unnest(range(len(w))) i, unnest(w) x from d),
m as (select a.r, a.i - b.i q, a.i from x a join x b on a.r = b.r and a.x = b.x and b.i < a.i join s on s.r = a.r where 4 * (a.i - b.i) <= s.n),
k as (select r, q, i, i - row_number() over (partition by r, q order by i) island from m),
l as (select r, q, min(i) - q s, count(*) + q n from k group by r, q, island),
u as (select r, s, n, min(q) q from l where n >= greatest(6, 4 * q) group by r, s, n),
t as (select r, count(*) n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' order by s, q) listed from u group by r),
b as (select * from u a where not exists (select 1 from u b where a.r = b.r
  and (b.n * a.q > a.n * b.q or b.n * a.q = a.n * b.q and (b.s < a.s or b.s = a.s and b.q < a.q)))),
g as (select distinct r, unnest(range(s + q, s + n)) i from u),
c as (select r, string_agg(x, ' ' order by i) kept from x anti join g using (r, i) group by r)
select doc_id, coalesce(n_runs, 0) n_runs, b.s start, b.n length, b.q period, 1000 * b.n // b.q exponent_milli,
  sha256(coalesce(listed, '')) runs_sha256, sha256(coalesce(kept, '')) collapsed_sha256
from d left join t using (r) left join b using (r) left join c using (r)"""

_SEARCH = f"""
with d as (select row_number() over () r, doc_id, {_LEAK_WORDS.format(t="text")} w from documents),
i as (select row_number() over () k, item_id, {_LEAK_WORDS.format(t="text")} w from benchmark),
s as (select count(*) filter (len(w) > 0) docs, sum(len(w))::bigint words from d),
t as (select distinct k, item_id, unnest(w) x from i),
p as (select r, x, count(*) tf from (select r, unnest(w) x from d) semi join t using (x) group by r, x),
f as (select x, count(*) df from p group by x),
q as (select r, x, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint
    * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(w) * docs) // words))) v
  from p join f using (x) join d using (r), s),
g as (select k, item_id, r, doc_id, sum(v)::bigint score from t join q using (x) join d using (r) group by all)
select item_id, row_number() over (partition by k order by score desc, doc_id, r)::int rank, doc_id, score from g where score > 0
qualify rank <= 50"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": _LEAKS,
        "op10_repetition": _REPETITION,
        "op11_periodic_runs": _RUNS,
        "op12_ranked_search": _SEARCH,
    }
