"""SQL equivalents of the registered queries, written the plain way (full self-joins, no skew handling)."""

from __future__ import annotations

import math

from gleaner.functions.hashing import (
    BLOOM_BITS,
    BLOOM_HASHES,
    FM_BUCKETS,
    FM_HASHES,
    SKETCH_PRIME,
    USER_MINHASH_BUCKETS,
    Hash,
    minhash_family,
    sketch_family,
)
from gleaner.functions.text import NUMBER, PUNCTUATION, SPACE_RANGES, WORD_WHOLE
from gleaner.operators import bloom
from gleaner.operators.graph import ROUNDS
from gleaner.operators.recommend import MIN_COMMON, NEIGHBOURS
from gleaner.operators.sketch import SAMPLE_SIZE
from gleaner.operators.textmodel import PROFILE_WORDS, TOP_WORDS
from gleaner.plans import bindings as b


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


SPACES = "[" + "".join(rf"\x{{{first:x}}}-\x{{{last:x}}}" for first, last in SPACE_RANGES) + "]+"
WORD_PREFIX = "^[a-zA-Z]+"
STOP = "(" + ", ".join(_text(w) for w in b.STOPWORDS) + ")"

REVIEWS = """reviews AS (
  SELECT l_orderkey * 8 + l_linenumber AS review_id, o_custkey AS user_id, l_partkey AS business_id,
         CAST(floor((l_quantity - 1) / 10) + 1 AS DOUBLE) AS stars, o_orderdate AS date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SPLIT = f"""{REVIEWS},
train AS (SELECT * FROM reviews WHERE date < TIMESTAMP '{b.TEST_FROM}'),
test AS (SELECT DISTINCT user_id, business_id FROM reviews WHERE date >= TIMESTAMP '{b.TEST_FROM}')"""

BUSINESS = """business AS (
  SELECT p_partkey AS business_id,
         CASE WHEN p_size <= 5 THEN NULL WHEN p_size <= 10 THEN ''
              ELSE p_type || ', ' || replace(p_name, ' ', ', ') END AS categories,
         CASE WHEN p_size >= 44 THEN NULL ELSE p_brand END AS state
  FROM part)"""

CATEGORIES = """categories AS (
  SELECT business_id, trim(unnest(string_split(categories, ','))) AS category
  FROM business WHERE categories IS NOT NULL AND categories <> '')"""

WORDS = f"""all_words AS (
  SELECT doc_id, doc_id % 50 AS user_id, source AS business_id,
         unnest(regexp_split_to_array(translate(lower(text), {_text(PUNCTUATION)}, ''), {_text(SPACES)})) AS word
  FROM documents),
words AS (SELECT * FROM all_words WHERE word <> '')"""

PAIRS = """p AS (SELECT DISTINCT l_orderkey AS basket_id, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey)"""

SUPPORT = f"s AS (SELECT CAST(ceil({b.SUPPORT_SHARE} * count(DISTINCT basket_id)) AS BIGINT) AS support, count(DISTINCT basket_id) AS n FROM p)"

SUBSETS = """subsets AS (
  SELECT basket_id, item AS items, item AS last, 1 AS size FROM p
  UNION ALL
  SELECT g.basket_id, g.items || '|' || p.item, p.item, g.size + 1
  FROM subsets g JOIN p ON p.basket_id = g.basket_id AND p.item > g.last)"""


def _top_words(pattern: str) -> str:
    return f"""WITH {WORDS},
counts AS (SELECT word, count(*) AS n FROM words
           WHERE regexp_matches(word, {_text(pattern)}) AND word NOT IN {STOP} GROUP BY word)
SELECT word, n FROM counts ORDER BY n DESC, word LIMIT {b.TOP}"""


def _baskets(key: str, item: str, min_size: int = 1) -> str:
    return f"""WITH {PAIRS},
q AS (SELECT {key} AS basket_id, {item} AS item FROM p)
SELECT basket_id, item, size FROM (SELECT basket_id, item, count(*) OVER (PARTITION BY basket_id) AS size FROM q)
WHERE size >= {min_size}"""


def _frequent(where: str = "TRUE", compare: str = ">=") -> str:
    return f"""WITH RECURSIVE {PAIRS}, {SUPPORT}, {SUBSETS}
SELECT items, size, count(*) AS support FROM subsets WHERE {where}
GROUP BY items, size HAVING count(*) {compare} (SELECT support FROM s)"""


CHUNK_SETS = f"""chunk_sizes AS (SELECT basket_id % {b.CHUNKS} AS chunk, count(DISTINCT basket_id) AS c FROM p GROUP BY 1),
chunk_sets AS (SELECT basket_id % {b.CHUNKS} AS chunk, items, size, count(*) AS support FROM subsets GROUP BY 1, 2, 3),
candidates AS (
  SELECT DISTINCT items, size FROM chunk_sets JOIN chunk_sizes USING (chunk), s
  WHERE chunk_sets.support >= (s.support * c + s.n - 1) // s.n)"""

REPORT = f"""WITH RECURSIVE {PAIRS}, {SUPPORT}, {SUBSETS}, {CHUNK_SETS},
frequent AS (SELECT items, size FROM subsets GROUP BY items, size HAVING count(*) >= (SELECT support FROM s)),
both_lists AS (SELECT 0 AS section, * FROM candidates UNION ALL SELECT 1, * FROM frequent),
placed AS (SELECT *, (row_number() OVER (PARTITION BY section, size ORDER BY string_split(items, '|')) - 1) // 1000 AS piece,
                  '(''' || replace(items, '|', ''', ''') || ''')' AS shown FROM both_lists),
lines AS (
  SELECT section, size, piece, string_agg(shown, ',' ORDER BY string_split(items, '|')) AS line FROM placed GROUP BY 1, 2, 3
  UNION ALL SELECT DISTINCT section, size, 1000000000, '' FROM placed
  UNION ALL VALUES (0, 0, 0, 'Candidates:'), (1, 0, 0, 'Frequent Itemsets:'))
SELECT row_number() OVER (ORDER BY section, size, piece) - 1 AS line_no, line FROM lines"""

PCY = f"""WITH {PAIRS}, {SUPPORT},
t AS (SELECT basket_id, (dense_rank() OVER (ORDER BY item) - 1)
             % CAST(floor((sqrt(16 * (SELECT n FROM s) + 1) - 1) / 2) AS BIGINT) AS r, item FROM p),
met AS (SELECT greatest(x.r, y.r) AS high, least(x.r, y.r) AS low FROM t x JOIN t y ON x.basket_id = y.basket_id AND x.item < y.item)
SELECT high * (high + 1) // 2 + low AS bucket, count(*) AS n FROM met
GROUP BY 1 HAVING count(*) >= (SELECT support FROM s)"""

# every way to pick one, two or three of the lines of an order, by the brands of the lines
MULTISETS = f"""WITH lines AS (SELECT l_orderkey AS o, p_brand AS item, row_number() OVER () AS i FROM lineitem JOIN part ON l_partkey = p_partkey),
s AS (SELECT CAST(ceil({b.SUPPORT_SHARE} * count(DISTINCT o)) AS BIGINT) AS support FROM lines),
x1 AS (SELECT item AS a, count(*) AS n FROM lines GROUP BY 1 HAVING count(*) > (SELECT support FROM s)),
x2 AS (SELECT least(x.item, y.item) AS a, greatest(x.item, y.item) AS b, count(*) AS n
       FROM lines x JOIN lines y ON x.o = y.o AND x.i < y.i GROUP BY 1, 2 HAVING count(*) > (SELECT support FROM s)),
t AS (SELECT list_sort([x.item, y.item, z.item]) AS l FROM lines x JOIN lines y ON x.o = y.o AND x.i < y.i JOIN lines z ON y.o = z.o AND y.i < z.i),
x3 AS (SELECT l, count(*) AS n FROM t GROUP BY 1 HAVING count(*) > (SELECT support FROM s))
SELECT a AS items, 1 AS size, n AS support FROM x1
UNION ALL SELECT a || '|' || b, 2, n FROM x2 WHERE a IN (SELECT a FROM x1) AND b IN (SELECT a FROM x1)
UNION ALL SELECT array_to_string(l, '|'), 3, n FROM x3 WHERE (l[1], l[2]) IN (SELECT (a, b) FROM x2)
  AND (l[1], l[3]) IN (SELECT (a, b) FROM x2) AND (l[2], l[3]) IN (SELECT (a, b) FROM x2)"""

TF = f"""{WORDS},
kept AS (SELECT business_id, word, count(*) AS n FROM words
         WHERE regexp_matches(word, {_text(WORD_PREFIX)}) AND length(word) > 3 AND word NOT IN {STOP}
         GROUP BY 1, 2),
weighed AS (SELECT business_id, word, n, sum(n) OVER (PARTITION BY business_id) AS total,
                   max(n) OVER (PARTITION BY business_id) AS most FROM kept),
tf AS (SELECT business_id, word, CAST(n AS DOUBLE) / CAST(total AS DOUBLE) AS tf FROM weighed WHERE n > 3 OR most <= 3)"""

TFIDF = f"""{TF},
idf AS (SELECT word, ln(CAST((SELECT count(DISTINCT source) FROM documents) AS DOUBLE) / count(*)) AS idf FROM tf GROUP BY word),
tfidf AS (SELECT business_id, word, tf * idf AS score FROM tf JOIN idf USING (word))"""

PROFILE = f"""{TFIDF},
profile AS (
  SELECT business_id, word, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY business_id ORDER BY round(score, 12), word) AS rank FROM tfidf)
  WHERE rank <= {PROFILE_WORDS})"""

USERS = f"""{PROFILE},
users AS (SELECT DISTINCT d.doc_id % 50 AS user_id, word FROM documents d JOIN profile ON d.source = business_id)"""

CONTENT = f"""{USERS},
asked AS (SELECT DISTINCT CAST(floor(doc_id / 20) AS BIGINT) % 50 AS user_id, source AS business_id FROM documents),
user_size AS (SELECT user_id, count(*) AS nu FROM users GROUP BY 1),
business_size AS (SELECT business_id, count(*) AS nb FROM profile GROUP BY 1),
content AS (
  SELECT user_id, business_id, count(*) / (sqrt(max(nu)) * sqrt(max(nb))) AS sim
  FROM asked JOIN users USING (user_id) JOIN profile USING (business_id, word)
  JOIN user_size USING (user_id) JOIN business_size USING (business_id)
  GROUP BY user_id, business_id
  HAVING count(*) / (sqrt(max(nu)) * sqrt(max(nb))) >= 0.01)"""

DOC_TF = f"""{WORDS},
counted AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY 1, 2),
weighed AS (SELECT *, sum(n) OVER (PARTITION BY doc_id) AS total FROM counted),
listed AS (SELECT doc_id, word, n, CAST(n AS DOUBLE) / CAST(total AS DOUBLE) AS tf FROM weighed
           WHERE word NOT IN {STOP} AND NOT regexp_matches(word, {_text(NUMBER)}))"""


def _family(name: str, family: list[Hash]) -> str:
    rows = ", ".join(f"({i}, {h.a}::HUGEINT, {h.c}::HUGEINT)" for i, h in enumerate(family))
    return f"{name}(i, a, c) AS (VALUES {rows})"


def _signatures(rows: str, buckets: int, hashes: int = b.SIM_HASHES) -> str:
    """``mins(item, i, h)`` over ``rows`` with ``item, token``."""
    family = minhash_family(hashes, buckets)
    return f"""{_family("family", family)},
mins AS (SELECT item, i, CAST(min(((a * token + c) % {family[0].prime}) % {buckets}) AS BIGINT) AS h
         FROM {rows}, family GROUP BY 1, 2)"""


def _bands(hashes: int, n_bands: int) -> str:
    width = hashes // n_bands
    return f"""bands AS (SELECT item, CAST(i // {width} + 1 AS INTEGER) AS band, string_agg(h, ' ' ORDER BY i) AS key
          FROM mins GROUP BY 1, 2)"""


# distinct reviews with the dense number of the user, items with equal user sets joined to one representative
SETS = f"""{REVIEWS},
coded AS (SELECT DISTINCT business_id AS item, user_id AS element, dense_rank() OVER (ORDER BY user_id) - 1 AS token FROM reviews),
prints AS (SELECT item, string_agg(element, ',' ORDER BY element) AS print FROM coded GROUP BY item),
reps AS (SELECT item, min(item) OVER (PARTITION BY print) AS rep FROM prints),
sets AS (SELECT * FROM coded WHERE item IN (SELECT rep FROM reps)),
sizes AS (SELECT item, count(*) AS size FROM sets GROUP BY item),
links AS (SELECT rep AS k1, item AS k2, 1.0::DOUBLE AS sim FROM reps WHERE item <> rep)"""

EXACT = f"""{SETS},
common AS (SELECT x.item AS k1, y.item AS k2, count(*) AS n FROM sets x JOIN sets y ON x.element = y.element AND x.item < y.item
           GROUP BY 1, 2),
scored AS (SELECT k1, k2, n / (s1.size + s2.size - n) AS sim FROM common
           JOIN sizes s1 ON s1.item = k1 JOIN sizes s2 ON s2.item = k2),
exact AS (SELECT * FROM scored WHERE sim >= {b.MIN_JACCARD} UNION ALL SELECT * FROM links)"""

LSH = f"""{EXACT},
{_signatures("sets", 42949)},
{_bands(b.SIM_HASHES, b.SIM_BANDS)},
near AS (SELECT DISTINCT x.item AS k1, y.item AS k2 FROM bands x JOIN bands y
         ON x.band = y.band AND x.key = y.key AND x.item < y.item),
lsh AS (SELECT scored.* FROM scored JOIN near USING (k1, k2) WHERE sim >= {b.MIN_JACCARD} UNION ALL SELECT * FROM links)"""


def _latest(source: str) -> str:
    return f"""(SELECT user_id, business_id, stars FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, business_id ORDER BY date DESC, review_id DESC, stars DESC) AS r
    FROM {source}) WHERE r = 1)"""


def _pearson(item: str, rater: str, lx: str = "l1.l", ly: str = "l2.l", extra: str = "", where: str = "TRUE") -> str:
    """``model(k1, k2, sim)``"""
    return f"""often AS (SELECT {item} FROM train GROUP BY 1 HAVING count(*) >= {MIN_COMMON}),
ratings AS (SELECT {item} AS item, {rater} AS rater, stars FROM {_latest("train")} WHERE {item} IN (SELECT * FROM often)),
lengths AS (SELECT item, count(*) AS l FROM ratings GROUP BY 1),
{extra}
sums AS (SELECT x.item AS k1, y.item AS k2, count(*) AS n, sum(x.stars) AS sx, sum(y.stars) AS sy,
                sum(x.stars * x.stars) AS sxx, sum(y.stars * y.stars) AS syy, sum(x.stars * y.stars) AS sxy
         FROM ratings x JOIN ratings y ON x.rater = y.rater AND x.item < y.item
         GROUP BY 1, 2 HAVING count(*) >= {MIN_COMMON}),
lens AS (SELECT sums.*, CAST({lx} AS DOUBLE) AS lx, CAST({ly} AS DOUBLE) AS ly FROM sums
         JOIN lengths l1 ON l1.item = k1 JOIN lengths l2 ON l2.item = k2 WHERE {where}),
parts AS (SELECT k1, k2, lx * ly * sxy - sx * sy * (lx + ly - n) AS top,
                 sqrt(greatest(lx * lx * sxx - sx * sx * (2 * lx - n), 0)) * sqrt(greatest(ly * ly * syy - sy * sy * (2 * ly - n), 0)) AS bottom
          FROM lens),
model AS (SELECT k1, k2, top / bottom AS sim FROM parts WHERE bottom <> 0 AND top / bottom > 0)"""


USER_NEAR = f"""tokens AS (SELECT business_id, row_number() OVER (ORDER BY business_id) - 1 AS token FROM (SELECT DISTINCT business_id FROM train)),
known AS (SELECT DISTINCT user_id AS item, token FROM train JOIN tokens USING (business_id)
          WHERE business_id IN (SELECT business_id FROM train GROUP BY 1 HAVING count(*) >= {MIN_COMMON})),
{_signatures("known", USER_MINHASH_BUCKETS)},
{_bands(b.SIM_HASHES, b.SIM_BANDS)},
near AS (SELECT DISTINCT x.item AS k1, y.item AS k2 FROM bands x JOIN bands y
         ON x.band = y.band AND x.key = y.key AND x.item < y.item),
"""

ITEM_MODEL = f"{SPLIT},\n" + _pearson("business_id", "user_id")
ITEM_MODEL_CORATED = f"{SPLIT},\n" + _pearson("business_id", "user_id", "sums.n", "sums.n")
USER_MODEL = f"{SPLIT},\n" + _pearson(
    "user_id", "business_id", extra=USER_NEAR,
    where="n / (l1.l + l2.l - n) >= 0.01 AND EXISTS (SELECT 1 FROM near WHERE near.k1 = sums.k1 AND near.k2 = sums.k2)",
)

USER_MODEL_EXACT = f"{SPLIT},\n" + _pearson("user_id", "business_id", where="n / (l1.l + l2.l - n) >= 0.01")

BOTH_WAYS = "both_ways AS (SELECT k1 AS target, k2 AS near, sim FROM model UNION ALL SELECT k2, k1, sim FROM model)"

ITEM_PREDICT = f"""WITH {ITEM_MODEL}, {BOTH_WAYS},
history AS (SELECT DISTINCT user_id, business_id AS near, stars FROM train),
chosen AS (SELECT user_id, business_id, sim, stars,
                  row_number() OVER (PARTITION BY user_id, business_id ORDER BY sim DESC, both_ways.near, stars) AS r
           FROM test JOIN history USING (user_id) JOIN both_ways ON target = business_id AND both_ways.near = history.near),
weighed AS (SELECT user_id, business_id, sum(sim * stars) AS top, sum(abs(sim)) AS weight FROM chosen
            WHERE r <= {NEIGHBOURS} GROUP BY 1, 2),
avgs AS (SELECT business_id, avg(stars) AS avg FROM train GROUP BY 1)
SELECT user_id, business_id,
       round(CASE WHEN weight = 0 OR top = 0 OR top IS NULL THEN coalesce(avg, (SELECT avg(stars) FROM train)) ELSE top / weight END, 6) AS stars,
       avg IS NULL AS cold_start
FROM test LEFT JOIN weighed USING (user_id, business_id) LEFT JOIN avgs USING (business_id)"""

USER_PREDICT = f"""WITH {USER_MODEL}, {BOTH_WAYS},
rated AS (SELECT DISTINCT business_id, user_id AS near, stars FROM train),
avgs AS (SELECT user_id, avg(stars) AS avg FROM train GROUP BY 1),
weighed AS (
  SELECT test.user_id, business_id, sum((stars - avgs.avg) * sim) AS top, sum(abs(sim)) AS weight
  FROM test JOIN rated USING (business_id)
  JOIN both_ways ON target = test.user_id AND both_ways.near = rated.near
  JOIN avgs ON avgs.user_id = rated.near GROUP BY 1, 2),
based AS (SELECT test.*, coalesce(avg, (SELECT avg(stars) FROM train)) AS base, avg IS NULL AS cold_start
          FROM test LEFT JOIN avgs USING (user_id) WHERE business_id IN (SELECT business_id FROM train))
SELECT user_id, business_id,
       round(CASE WHEN weight = 0 OR top = 0 OR top IS NULL THEN base ELSE base + top / weight END, 6) AS stars, cold_start
FROM based LEFT JOIN weighed USING (user_id, business_id)"""

EDGES = f"""{REVIEWS},
adjacency AS (SELECT DISTINCT user_id, business_id FROM reviews),
chance AS (SELECT (count(*) / count(DISTINCT user_id)) * (count(*) / count(DISTINCT user_id)) / count(DISTINCT business_id) AS c FROM adjacency),
edges AS MATERIALIZED (
  SELECT x.user_id AS src, y.user_id AS dst, count(*) AS n FROM adjacency x JOIN adjacency y
  ON x.business_id = y.business_id AND x.user_id < y.user_id GROUP BY 1, 2
  HAVING count(*) >= (SELECT greatest(3, ceil(c + 3 * sqrt(c) + 1)) FROM chance))"""


def _label_rounds() -> str:
    steps = [f"""{EDGES},
links AS MATERIALIZED (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges),
labels0 AS (SELECT DISTINCT src AS id, src AS label FROM links)"""]
    for r in range(1, ROUNDS + 1):
        steps.append(f"""labels{r} AS MATERIALIZED (
  SELECT id, label FROM (
    SELECT dst AS id, label, row_number() OVER (PARTITION BY dst ORDER BY count(*) DESC, label) AS place
    FROM links JOIN labels{r - 1} ON src = id GROUP BY dst, label) WHERE place = 1)""")
    return ",\n".join(steps)


LABELS = _label_rounds()
COMMUNITIES = f"""{LABELS},
members AS (SELECT label, count(*) OVER (PARTITION BY label) AS size, id AS member FROM labels{ROUNDS})"""

COMMUNITY_LINES = f"""WITH {COMMUNITIES},
placed AS (SELECT size, member, min(member) OVER (PARTITION BY label) AS first,
                  (row_number() OVER (PARTITION BY label ORDER BY member) - 1) // 1000 AS piece FROM members),
lines AS (SELECT size, first, piece, string_agg('''' || member || '''', ', ' ORDER BY member) AS line FROM placed GROUP BY 1, 2, 3)
SELECT row_number() OVER (ORDER BY size, first, piece) - 1 AS line_no, line FROM lines"""


def _text_number(column: str) -> str:
    digits = f"list_transform(string_split({column}, ''), lambda ch: ord(ch)::HUGEINT)"
    return f"list_reduce({digits}, lambda acc, v: (acc * 256 + v) % {SKETCH_PRIME}, 0::HUGEINT)"


BLOOM = f"""{_family("family", sketch_family(BLOOM_HASHES, BLOOM_BITS))},
bits AS (SELECT DISTINCT CAST(((a * {_text_number("c_name")} + c) % {SKETCH_PRIME}) % {BLOOM_BITS} AS BIGINT) AS pos
         FROM customer, family WHERE c_mktsegment = 'BUILDING' AND c_name <> '')"""

BLOOM_PROBE = f"""WITH {BLOOM},
asked AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name END AS c_name FROM customer),
hits AS (SELECT c_custkey, count(*) AS hit FROM (
    SELECT c_custkey, CAST(((a * {_text_number("c_name")} + c) % {SKETCH_PRIME}) % {BLOOM_BITS} AS BIGINT) AS pos
    FROM asked, family WHERE c_name <> '') JOIN bits USING (pos) GROUP BY 1)
SELECT c_custkey, c_name, CASE WHEN c_name IS NOT NULL AND hit = {BLOOM_HASHES} THEN 1 ELSE 0 END AS flag
FROM asked LEFT JOIN hits USING (c_custkey)"""



def _spots(shape: bloom.Shape) -> str:
    """Bits of a block for the MD5 ``d``."""
    high, low = "('0x' || substr(d, 17, 8))::BIGINT", "('0x' || substr(d, 25, 8))::BIGINT"
    bits = [f"({half} >> {9 * i}) & 511" for half in (high, low) for i in range(3)] + [f"((({high} >> 27) << 5) + ({low} >> 27)) & 511"]
    return "[" + ", ".join(bits[: shape.hashes]) + "]"


_SHAPE = bloom.shape_for(512, b.BLOOM_RATE)  # its hashes hold for any number of keys
_PER_KEY = bloom.BLOCK_COST * -math.log(b.BLOOM_RATE) / math.log(2) ** 2
ORDER_FILTER = f"""asked AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN 'order' || o_orderkey END AS name FROM orders),
keys AS (SELECT DISTINCT name FROM asked WHERE o_orderstatus = 'F'),
shape AS (SELECT greatest(1, CAST(ceil(count(*) * {_PER_KEY!r}::DOUBLE / 512) AS BIGINT)) AS blocks FROM keys),
digests AS (SELECT name, name IN (SELECT name FROM keys) AS is_key, md5(name) AS d FROM (SELECT DISTINCT name FROM asked WHERE name IS NOT NULL)),
spots AS (SELECT name, is_key, ('0x' || substr(d, 1, 15))::BIGINT % blocks AS block, unnest({_spots(_SHAPE)}) AS bit FROM digests, shape),
bits AS (SELECT DISTINCT block, bit FROM spots WHERE is_key),
hits AS (SELECT name FROM (SELECT DISTINCT name, block, bit FROM spots) x LEFT JOIN bits y ON x.block = y.block AND x.bit = y.bit
         GROUP BY name HAVING count(*) = count(y.bit))"""

CITIES = "cities AS (SELECT ts, CASE WHEN event_type <> 'error' THEN 'u' || user_id END AS city FROM events)"


def _fm(source: str, group: str, having: str = "TRUE") -> str:
    """Estimate over ``source`` (the group columns and ``city``)."""
    lead = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""{_family("family", sketch_family(FM_HASHES, FM_BUCKETS))},
vals AS (SELECT DISTINCT {lead}city, {_text_number("city")} AS x FROM {source} WHERE city <> ''),
hashed AS (SELECT {lead}city, i, CAST(((a * x + c) % {SKETCH_PRIME}) % {FM_BUCKETS} AS BIGINT) AS h FROM vals, family),
tails AS (SELECT {lead}i, max(CASE WHEN h = 0 THEN 20 ELSE bit_count((h & -h) - 1) END) AS r, count(DISTINCT city) AS d
          FROM hashed GROUP BY {lead}i)
SELECT {lead}max(d) AS exact, CAST(floor(sum(pow(2, r)) / {2 * FM_HASHES}) AS BIGINT) AS estimate
FROM tails WHERE {having} {by}"""


WINDOWS = """slots AS (
  SELECT to_timestamp(CAST(floor(epoch(ts) / 600) AS BIGINT) * 600 - k * 600)::TIMESTAMPTZ AS w, city
  FROM cities, (VALUES (0), (1), (2)) AS back(k)),
named AS (SELECT strftime(w AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS window_start, city FROM slots)"""

FM_WINDOWS = f"WITH {CITIES}, {WINDOWS}, {_fm('named', 'window_start')}"

_PRIORITY = sketch_family(1, SKETCH_PRIME)[0]
SAMPLE = f"""messages AS (
  SELECT event_id, ['k' || json_extract_string(props, '$.k'), event_type] AS tags FROM events WHERE event_type <> 'view'),
sample AS (SELECT * FROM messages
           ORDER BY ({_PRIORITY.a}::HUGEINT * event_id + {_PRIORITY.c}) % {SKETCH_PRIME}, event_id LIMIT {SAMPLE_SIZE})"""


def oracle_sql() -> dict[str, str]:
    return {
        "q_review_stats": f"""WITH {REVIEWS} SELECT count(*) AS total,
            count(*) FILTER (WHERE year(date) = {b.YEAR}) AS in_year, count(DISTINCT user_id) AS users FROM reviews""",
        "q_top_users": f"""WITH {REVIEWS} SELECT user_id, count(*) AS n FROM reviews GROUP BY 1
            ORDER BY n DESC, user_id LIMIT {b.TOP}""",
        "q_top_words": _top_words(WORD_PREFIX),
        "q_top_words_full": _top_words(WORD_WHOLE),
        "q_category_avg": f"""WITH {REVIEWS}, {BUSINESS}, {CATEGORIES},
            a AS (SELECT category, sum(stars) / count(stars) AS stars FROM categories JOIN reviews USING (business_id) GROUP BY 1)
            SELECT category, round(stars, 6) AS stars FROM a ORDER BY a.stars DESC, category LIMIT {b.TOP}""",
        "q_category_avg_all": f"""WITH {REVIEWS}, {BUSINESS}, {CATEGORIES}
            SELECT category, round(coalesce(sum(stars) / nullif(count(stars), 0), 0), 6) AS stars
            FROM categories LEFT JOIN reviews USING (business_id) GROUP BY 1""",
        "q_popular": f"""WITH {REVIEWS} SELECT business_id, count(*) AS n FROM reviews GROUP BY 1
            HAVING count(*) > {b.POPULAR_OVER}""",
        "q_partition_stats": f"""WITH {REVIEWS} SELECT CAST(r.i AS INTEGER) AS pid, count(business_id) AS n_items
            FROM range(8) r(i) LEFT JOIN reviews ON business_id % 8 = r.i GROUP BY 1""",
        "q_semi_state": f"""WITH {REVIEWS}, {BUSINESS} SELECT user_id, business_id FROM reviews
            WHERE business_id IN (SELECT business_id FROM business WHERE coalesce(state, '') = '{b.STATE}')""",
        "q_baskets": _baskets("basket_id", "item"),
        "q_baskets_swapped": _baskets("item", "basket_id"),
        "q_baskets_min": _baskets("basket_id", "item", 5),
        "q_itemsets": _frequent(),
        "q_itemsets_son": _frequent(),
        "q_itemsets_fpgrowth": _frequent(),
        "q_apriori3": _frequent("size <= 3", ">"),
        "q_pcy_pairs": _frequent("size = 2", ">"),
        "q_pcy_multi": _frequent("TRUE", ">"),
        "q_itemset_candidates": f"WITH RECURSIVE {PAIRS}, {SUPPORT}, {SUBSETS}, {CHUNK_SETS} SELECT items, size FROM candidates",
        "q_itemset_report": REPORT,
        "q_pcy_buckets": PCY,
        "q_multisets3": MULTISETS,
        "q_tf": f"WITH {TF} SELECT business_id, word, round(tf, 6) AS tf FROM tf",
        "q_idf": f"WITH {TFIDF} SELECT word, round(idf, 6) AS idf FROM idf",
        "q_tfidf": f"WITH {TFIDF} SELECT business_id, word, round(score, 6) AS score FROM tfidf",
        "q_tfidf_profile": f"WITH {PROFILE} SELECT business_id, word, rank FROM profile",
        "q_tfidf_top": f"""WITH {DOC_TF},
            idf AS (SELECT word, ln(CAST((SELECT count(*) FROM documents) AS DOUBLE) / count(*)) AS idf FROM listed GROUP BY 1),
            scored AS (SELECT doc_id, word, tf * idf AS score FROM listed JOIN idf USING (word) WHERE tf * idf > 0)
            SELECT doc_id, word, round(score, 6) AS score FROM (
              SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 12) DESC, word) AS r FROM scored)
            WHERE r <= {TOP_WORDS}""",
        "q_doc_top_words": f"""WITH {DOC_TF} SELECT doc_id, word, n FROM (
              SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, word) AS r FROM listed) WHERE r <= 20""",
        "q_user_profile": f"WITH {USERS} SELECT user_id, word FROM users",
        "q_profile_model": f"""WITH {USERS},
            tokens AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS token FROM (SELECT DISTINCT word FROM profile))
            SELECT 'business_profile' AS description, CAST(business_id AS VARCHAR) AS id, token FROM profile JOIN tokens USING (word)
            UNION ALL SELECT 'user_profile', CAST(user_id AS VARCHAR), token FROM users JOIN tokens USING (word)""",
        "q_content_predict": f"WITH {CONTENT} SELECT user_id, business_id, round(sim, 6) AS sim FROM content",
        "q_hit_rate": f"""WITH {CONTENT} SELECT count(sim) AS hits, count(*) AS total, round(count(sim) / count(*), 6) AS rate
            FROM asked LEFT JOIN content USING (user_id, business_id)""",
        "q_token_dict": f"""WITH {REVIEWS} SELECT user_id AS id, row_number() OVER (ORDER BY user_id) - 1 AS token
            FROM (SELECT DISTINCT user_id FROM reviews)""",
        "q_minhash": f"""WITH {SETS}, {_signatures("coded", 42949)}
            SELECT item, string_agg(h, ' ' ORDER BY i) AS sig FROM mins GROUP BY item""",
        "q_lsh_buckets": f"""WITH {SETS}, {_signatures("coded", 42949)}, {_bands(b.SIM_HASHES, b.SIM_BANDS)}
            SELECT band, key, item, members FROM (
              SELECT band, key, item, count(*) OVER (PARTITION BY band, key) AS members FROM bands) WHERE members > 1""",
        "q_lsh_candidates": f"""WITH {SETS}, {_signatures("coded", 42949)}, {_bands(b.SIM_HASHES, b.SIM_BANDS)},
            near AS (SELECT DISTINCT x.item AS k1, y.item AS k2 FROM bands x JOIN bands y
                     ON x.band = y.band AND x.key = y.key AND x.item < y.item),
            held AS (SELECT DISTINCT business_id AS item, user_id AS element FROM reviews),
            n AS (SELECT item, count(*) AS size FROM held GROUP BY 1),
            met AS (SELECT k1, k2, count(*) AS n FROM near JOIN held x ON x.item = k1
                    JOIN held y ON y.item = k2 AND y.element = x.element GROUP BY 1, 2)
            SELECT k1, k2 FROM met JOIN n a ON a.item = k1 JOIN n b ON b.item = k2
            WHERE met.n / (a.size + b.size - met.n) >= {b.MIN_JACCARD}""",
        "q_jaccard_lsh": f"WITH {EXACT} SELECT k1, k2, round(sim, 6) AS sim FROM exact",
        "q_jaccard_exact": f"WITH {EXACT} SELECT k1, k2, round(sim, 6) AS sim FROM exact",
        "q_lsh_recall": f"""WITH {LSH} SELECT (SELECT count(*) FROM lsh) AS found, (SELECT count(*) FROM exact) AS known,
            round((SELECT count(*) FROM lsh) / (SELECT count(*) FROM exact), 6) AS recall""",
        "q_ratings_dedup": f"WITH {REVIEWS} SELECT user_id, business_id, stars FROM {_latest('reviews')}",
        "q_pearson_item": f"WITH {ITEM_MODEL} SELECT k1, k2, round(sim, 6) AS sim FROM model",
        "q_pearson_item_corated": f"WITH {ITEM_MODEL_CORATED} SELECT k1, k2, round(sim, 6) AS sim FROM model",
        "q_pearson_user": f"WITH {USER_MODEL} SELECT k1, k2, round(sim, 6) AS sim FROM model",
        "q_pearson_user_exact": f"WITH {USER_MODEL_EXACT} SELECT k1, k2, round(sim, 6) AS sim FROM model",
        "q_cf_item_predict": ITEM_PREDICT,
        "q_cf_user_predict": USER_PREDICT,
        "q_cooccur_edges": f"WITH {EDGES} SELECT src, dst, n FROM edges",
        "q_graph_nodes": f"WITH {EDGES} SELECT src AS id FROM edges UNION SELECT dst FROM edges",
        "q_communities": f"WITH {LABELS} SELECT id, label FROM labels{ROUNDS}",
        "q_community_list": f"WITH {COMMUNITIES} SELECT label, size, member FROM members",
        "q_community_lines": COMMUNITY_LINES,
        "q_bloom_bits": f"WITH {BLOOM} SELECT pos FROM bits",
        "q_bloom_probe": BLOOM_PROBE,
        "q_bloom_blocks": f"WITH {ORDER_FILTER} SELECT block, string_agg(bit, ' ' ORDER BY bit) AS bits FROM bits GROUP BY block",
        "q_bloom_member": f"""WITH {ORDER_FILTER} SELECT o_orderkey, name, CASE WHEN name IN (SELECT name FROM hits) THEN 1 ELSE 0 END AS flag
            FROM asked""",
        "q_bloom_quality": f"""WITH {ORDER_FILTER},
            n AS (SELECT count(*) FILTER (is_key) AS present, 0::BIGINT AS missed, count(*) FILTER (NOT is_key) AS absent,
                         count(*) FILTER (NOT is_key AND name IN (SELECT name FROM hits)) AS wrong FROM digests)
            SELECT present, missed, absent, wrong, TRUE AS within FROM n""",
        "q_fm": f"WITH {CITIES}, {_fm('cities', '')}",
        "q_fm_windows": FM_WINDOWS,
        "q_fm_windows_stream": FM_WINDOWS,
        "q_fm_windows_merged": f"SELECT *, TRUE AS near FROM ({FM_WINDOWS})",
        "q_reservoir_tags": f"WITH {SAMPLE} SELECT unnest(tags) AS tag, count(*) AS n FROM sample GROUP BY 1",
        "q_tracked_tags": f"""WITH m AS (SELECT doc_id, list_slice(string_split(text, ' '), 1, 3) AS tags FROM documents
              WHERE lang = 'en' AND list_has_any(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+'), {b.TRACKED!r})),
            sample AS (SELECT * FROM m ORDER BY ({_PRIORITY.a}::HUGEINT * doc_id + {_PRIORITY.c}) % {SKETCH_PRIME}, doc_id LIMIT {SAMPLE_SIZE})
            SELECT unnest(tags) AS tag, count(*) AS n FROM sample GROUP BY 1""",
        "q_json_reviews": f"""WITH {REVIEWS} SELECT count(*) AS total,
            count(*) FILTER (WHERE year(date) = {b.YEAR}) AS in_year, count(DISTINCT user_id) AS users FROM reviews""",
        "q_csv_pairs": """WITH p AS (SELECT DISTINCT CAST(doc_id % 50 AS VARCHAR) AS basket_id, CAST(source AS VARCHAR) AS item FROM documents)
            SELECT basket_id, item, count(*) OVER (PARTITION BY basket_id) AS size FROM p""",
        "q_basket_lines": f"WITH {PAIRS} SELECT item, count(*) AS n FROM p GROUP BY 1",
        "q_stopword_table": _top_words(WORD_PREFIX),
        "q_document_lines": _top_words(WORD_PREFIX),
        "q_report_lines": REPORT,
        "q_review_report": f"""WITH {REVIEWS},
            u AS (SELECT user_id, count(*) AS n FROM reviews GROUP BY 1 ORDER BY n DESC, user_id LIMIT {b.TOP}),
            w AS ({_top_words(WORD_PREFIX)})
            SELECT count(*) AS total, count(*) FILTER (WHERE year(date) = {b.YEAR}) AS in_year, count(DISTINCT user_id) AS users,
              (SELECT string_agg(user_id || ':' || n, ' ' ORDER BY n DESC, user_id) FROM u) AS top_users,
              (SELECT string_agg(word, ' ' ORDER BY word) FROM w) AS top_words FROM reviews""",
        "q_csv_ordered": f"""WITH {REVIEWS}, {BUSINESS} SELECT row_number() OVER (ORDER BY user_id, business_id) AS line_no, user_id, business_id
            FROM reviews WHERE business_id IN (SELECT business_id FROM business WHERE coalesce(state, '') = '{b.STATE}')""",
        "q_windows_csv": f"SELECT row_number() OVER (ORDER BY window_start) AS line_no, * FROM ({FM_WINDOWS})",
        "q_membership_lines": f"""WITH f AS ({BLOOM_PROBE}), l AS (SELECT flag, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM f)
            SELECT pos // 1000 AS line_no, string_agg(flag, ' ' ORDER BY pos) AS line FROM l GROUP BY 1""",
        "q_model_store": f"""WITH {USERS},
            tokens AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS token FROM (SELECT DISTINCT word FROM profile))
            SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS n, min(token) AS least, max(token) AS most
            FROM users JOIN tokens USING (word) GROUP BY 1""",
        "q_content_predict_stored": f"WITH {CONTENT} SELECT user_id, business_id, round(sim, 6) AS sim FROM content",
        "q_cf_item_predict_ready": ITEM_PREDICT,
        "q_reservoir_stream": f"WITH {SAMPLE} SELECT event_id, array_to_string(tags, '|') AS tags FROM sample",
    }
