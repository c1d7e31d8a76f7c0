"""Main text of web pages by nearest-URL page differencing."""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import per_text
from gleaner.operators.numbering import numbered
from gleaner.operators.skew import skew_join
from gleaner.session import written

RAW = "script|style|noscript|template|textarea|title|iframe|svg|select|object"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*(?:/>|>.*?(?:</(?P=raw)\s*>|\Z)|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^\"'>])*|[^>]*)(?:>|\Z)",
    re.S | re.I,
)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
APART = frozenset("head nav header footer aside form button dialog menu".split())
#: Parts of class, id and role values that mark an element as no article.
MARKED = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead "
    "cookie cookies consent notice popup modal newsletter subscribe comment comments reply replies respond disqus share sharing social related widget search".split()
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""\bhidden\b(?!\s*=\s*["']?false)|display\s*:\s*none""", re.I)
COMMENTS = re.compile(r"comment|repl|respond|disqus", re.I)  # may hold articles of their own
ARTICLE, OPEN, BOILER = 2, 1, 0  # where a line stands
LARGE = 4_000_000  # cells of an alignment table kept at once
NEAR_WHOLE = 0.8  # a neighbour with this share of a page's text outside menus and the like is a near-whole copy of it


def _apart(tag: str, rest: str) -> bool:
    if tag in APART:
        return True
    if not rest or "=" not in rest:
        return False
    names = re.split(r"[^a-z0-9]+", " ".join(a or b or c for a, b, c in NAMED.findall(rest)).lower())
    return not MARKED.isdisjoint(names) or bool(HIDDEN.search(rest))


def lines(page: str) -> list[tuple[int, str]]:
    """The blocks of a page in order: where each stands and its text, references decoded, white space made one space.

    Broken pages are read as far as they go: an element without an end reaches to the next article or the page's end.
    """
    out: list[tuple[int, str]] = []
    held: list[str] = []
    inside = skipped = at = 0  # open articles; open elements of the name that is skipped
    skip = skip_rest = ""

    def close() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                out.append((BOILER if skip else ARTICLE if inside else OPEN, text))
            held.clear()

    for m in TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m["raw"]:
                close()
            continue
        end = bool(m["end"])
        if tag not in INLINE:
            close()
        if tag in ("article", "main"):
            if skip and not end and not COMMENTS.search(skip_rest):  # whatever else is open ends where an article begins
                skip = ""
            if not skip:
                if not end and _apart(tag, m["rest"]):
                    close()
                    skip, skipped, skip_rest = tag, 1, m["rest"]
                else:
                    inside = max(0, inside + (-1 if end else 1))
                continue
        if skip:
            if tag == skip:
                close()
                skipped += -1 if end else 1
                if not skipped:
                    skip = ""
        elif not end and tag not in VOID and not m["rest"].endswith("/") and _apart(tag, m["rest"]):
            close()
            skip, skipped, skip_rest = tag, 1, m["rest"]
    held.append(page[at:])
    close()
    return out


def _row(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Last row of the table of common subsequences of ``a`` and ``b``."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        np.maximum.accumulate(np.concatenate(([0], np.where(b == x, row[:-1] + 1, row[1:]))), out=row)
    return row


def common(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[len(a) - 1 - high] == b[len(b) - 1 - high]:
        high += 1
    ends = [*range(low), *range(len(a) - high, len(a))]
    at = low + np.flatnonzero(np.isin(a[low : len(a) - high], b[low : len(b) - high]))
    a = a[at]
    b = b[low : len(b) - high]
    b = b[np.isin(b, a)]
    return sorted([*ends, *(int(at[k]) for k in _middle(a, b))])


def _middle(a: np.ndarray, b: np.ndarray) -> list[int]:
    if not len(a) or not len(b):
        return []
    if len(a) == 1:
        return [0] if a[0] in b else []
    if len(a) * len(b) > LARGE:  # halves of a, at the split of b where their lengths add up to most
        half = len(a) // 2
        cut = int(np.argmax(_row(a[:half], b) + _row(a[half:][::-1], b[::-1])[::-1]))
        return _middle(a[:half], b[:cut]) + [half + k for k in _middle(a[half:], b[cut:])]
    table = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i, x in enumerate(a):
        np.maximum.accumulate(np.concatenate(([0], np.where(b == x, table[i, :-1] + 1, table[i, 1:]))), out=table[i + 1])
    out, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.append(i)
        elif table[i - 1, j] >= table[i, j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def _line_hashes():
    import xxhash

    def run(texts: list[bytes]) -> list:
        return [[[xxhash.xxh64_intdigest(t) - (1 << 63) for _, t in lines(x.decode("utf-8", "replace"))] for x in texts]]

    return run


def _shared_lines(batches):
    """Lines of a page that the nearer of its neighbours has too, by the longer common beginning of the paths."""
    for batch in batches:
        own, path, before, path_before, after, path_after = (batch.column(k).to_pylist() for k in range(1, 7))
        found = []
        for k, mine in enumerate(own):
            near = [(len(_prefix(path[k] or "", p or "")), x) for p, x in ((path_before[k], before[k]), (path_after[k], after[k])) if x is not None]
            if not near or not mine:
                found.append([])
                continue
            other = near[0][1] if len(near) == 1 or near[0][0] >= near[1][0] else near[1][1]
            found.append(common(np.array(mine), np.array(other, dtype=np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["_group", "shared"])


def _prefix(a: str, b: str) -> str:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return a[:n]


def _packed_lines():
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    return lambda texts: [[pack("\n".join(f"{place}{text}" for place, text in lines(x.decode("utf-8", "replace"))).encode()) for x in texts]]


def _texts(batches):
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts = []
        for packed, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            listed = [(int(x[0]), x[1:]) for x in unpack(packed).decode().split("\n") if x]
            dropped = {k for k in gone or () if listed[k][0] != BOILER}
            size = sum(len(text) for place, text in listed if place != BOILER)
            if sum(len(listed[k][1]) for k in dropped) >= NEAR_WHOLE * size:  # differencing with a copy says nothing of the article
                dropped = {k for k in dropped if listed[k][0] != ARTICLE}
            texts.append("\n".join(text for k, (place, text) in enumerate(listed) if k not in dropped and place != BOILER))
        chars = pa.array(map(len, texts), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), chars], names=["_id", "_url", "text", "n_chars"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, ``text`` (blocks of the main text, one a line) and ``n_chars``.

    Pages of a host stand in the order of their paths, pages of equal lines once, at the first of their paths. Each is
    aligned with the nearer of its two neighbours by a longest common subsequence of lines, and the lines both have are
    deleted, in and out of articles. A check against the markup follows: what stands in menus, headers, footers, sidebars,
    notices, adverts, forms or comments goes also when no neighbour has it, and where the neighbour is a near-whole copy
    (``NEAR_WHOLE``) the lines of a marked article stay. Only line hashes are sorted and aligned; a hot host is many range
    partitions. Pages meet their deletions as compressed lines, without markup. Null and empty pages have no text, null
    urls are one host, a host of one page deletes nothing; repeated rows each keep their row.
    """
    source = pages.select(
        F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"), F.col(html_col).cast("string").alias("_html")
    ).withColumn("_key", F.xxhash64("_id", "_url", "_html"))
    rest = F.regexp_replace(F.coalesce("_url", F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    placed = source.select("_key", host.alias("_host"), path.alias("_path"), "_html")
    hashed = per_text(placed, "_html", ["_key", "_host", "_path"], [("_lines", T.ArrayType(T.LongType()), pa.list_(pa.int64()))], _line_hashes)
    listed = written(hashed.withColumn("_group", F.xxhash64("_host", "_lines")), "lines")
    first = listed.groupBy("_group").agg(F.min(F.struct("_host", "_path", "_key", "_lines")).alias("_p")).select("_group", "_p.*")
    ranked = written(numbered(first, ["_host", "_path", "_key"], "_at"), "ranked")
    side = lambda step, name: ranked.select(
        (F.col("_at") + step).alias("_at"), F.col("_host").alias(f"_h{name}"), F.col("_path").alias(f"_p{name}"), F.col("_lines").alias(f"_l{name}")
    )
    beside = ranked.join(side(1, "b"), "_at", "left").join(side(-1, "a"), "_at", "left")
    of_host = lambda name: F.when(F.col(f"_h{name}") == F.col("_host"), F.col(f"_l{name}"))
    pairs = beside.select("_group", "_lines", "_path", of_host("b").alias("_lb"), "_pb", of_host("a").alias("_la"), "_pa")
    found = written(pairs.mapInArrow(_shared_lines, "_group long, shared array<int>").filter(F.size("shared") > 0), "shared")
    shared = skew_join(listed.select("_key", "_group").distinct(), found, "_group").select("_key", "shared")
    packed = per_text(source, "_html", ["_key", "_id", "_url"], [("_packed", T.BinaryType(), pa.binary())], _packed_lines)
    joined = packed.join(shared, "_key", "left").select("_id", "_url", "_packed", "shared")
    schema = T.StructType([T.StructField("_id", source.schema["_id"].dataType), *T._parse_datatype_string("_url string, text string, n_chars long").fields])
    return joined.mapInArrow(_texts, schema).select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", "n_chars")
