"""Quality rules from suffix arrays: how much of a text its own repeated word sequences cover."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import per_text

SYMBOLS = b"#*$%&|<>"
BASE_WINDOW = 3


def longest_repeats(names: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For every position the length of the longest word sequence from there that its document has twice.

    The suffix array comes from prefix doubling: a round names sequences of twice the length and sorts again only
    suffixes that still share their name. Common prefixes of neighbours follow from the names kept of each round.
    Sequences never reach over the end of a document.
    """
    n = len(names)
    if not n:
        return np.zeros(0, np.int64)
    key = doc.astype(np.int64) * (int(names.max()) + 1) + names
    array = np.argsort(key, kind="stable")
    rank, slots = np.empty(n + 1, np.int32), np.arange(n)
    rank[n] = -1

    def rename(suffixes: np.ndarray, slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Name each suffix by the first slot of its group; the slots that still share a name."""
        first = np.concatenate(([True], keys[1:] != keys[:-1]))
        rank[suffixes] = slots[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
        return slots[~(first & np.append(first[1:], True))]

    slots = rename(array, slots, key[array])
    rounds = [(rank.copy(), slots)]
    step = 1
    while len(slots):
        suffixes = array[slots]
        after = np.minimum(suffixes + step, n - 1)
        inside = (suffixes + step < n) & (doc[after] == doc[suffixes])
        follow = np.where(inside, rank[after].astype(np.int64), -1 - suffixes)  # a sequence cut by the end is unlike all others
        keys = rank[suffixes].astype(np.int64) * (2 * n + 2) + follow + n + 1
        order = np.argsort(keys, kind="stable")
        array[slots] = suffixes[order]
        slots = rename(suffixes[order], slots, keys[order])
        rounds.append((rank.copy(), slots))
        step *= 2
    common = np.zeros(max(n - 1, 0), np.int64)  # of array[j] and array[j + 1]
    found = np.zeros(0, np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        named, shared = rounds[k]
        pairs = np.union1d(found, shared[shared < n - 1])
        left, right = array[pairs] + common[pairs], array[pairs + 1] + common[pairs]
        same = pairs[named[np.minimum(left, n)] == named[np.minimum(right, n)]]
        common[same] += 1 << k
        found = np.union1d(found, same)
    longest = np.empty(n, np.int64)
    longest[array] = np.maximum(np.append(common, 0), np.insert(common, 0, 0))
    return longest


def covered(longest: np.ndarray, least: int, fixed: int | None = None) -> np.ndarray:
    """Positions in the union of the spans of repeats of ``least`` words or more (of ``fixed`` words each)."""
    starts = np.flatnonzero(longest >= least)
    change = np.zeros(len(longest) + 1, np.int64)
    change[starts] += 1
    np.add.at(change, starts + (longest[starts] if fixed is None else fixed), -1)
    return np.cumsum(change[:-1]) > 0


def _measure(least: int):
    def run(texts: list[bytes]) -> list:
        words = [t.split() for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        doc = np.repeat(np.arange(len(texts)), sizes)
        ids: dict[bytes, int] = {}
        names = np.array([ids.setdefault(x, len(ids)) for w in words for x in w], np.int64)
        longest = longest_repeats(names, doc)
        per = lambda flags: np.bincount(doc, weights=flags, minlength=len(texts)).astype(np.int64)
        most = np.zeros(len(texts), np.int64)
        np.maximum.at(most, doc, longest)
        chars, symbols, lines = [], [], []
        for text, listed in zip(texts, words, strict=True):
            chars.append(sum(map(len, listed)) if text.isascii() else len(b"".join(listed).decode("utf-8", "replace")))
            symbols.append(len(text) - len(text.translate(None, SYMBOLS)))
            full = [line for line in text.split(b"\n") if line and not line.isspace()]
            lines.append(len(full) - len(set(full)))
        return [sizes, chars, symbols, lines, per(covered(longest, BASE_WINDOW, BASE_WINDOW)), per(covered(longest, least)), most]

    return run


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 8) -> DataFrame:
    """Counts of every row: ``n_words word_chars n_symbols n_dup_lines n_repeat_words`` and, from the suffix array of its
    words, ``n_covered`` (words within repeats of ``least`` words or more) and ``longest_repeat`` (words).

    Words are runs of anything but ASCII white space. Null and empty texts count zero throughout; repeated rows and ids
    each get their own row. Nothing is shuffled; a task holds the arrays of one slice of texts, or of one long text.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]
    return per_text(docs, text_col, [id_col], [(name, T.LongType(), pa.int64()) for name in names], lambda: _measure(least))


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 8,
    max_covered: float = 0.3,
    max_longest: float = 0.15,
) -> DataFrame:
    """``repetition`` with the verdicts: ``base_failed`` (under 50 words, or over half of them in repeated 3-word windows)
    and ``kept`` (base rules passed, at most the share ``max_covered`` of the words in repeats, and no repeat longer than the
    share ``max_longest`` of the text). Texts without words fail the base rules.

    Words of long repeats are words of repeated 3-word windows too, so only a ``max_covered`` below the half of the base rule
    decides anything. Repeats that lie apart cover two times their length or more; one that overlaps itself, a stutter,
    covers little more than its length, and only ``max_longest`` sees it.
    """
    measured = repetition(docs, id_col, text_col, least)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    most = lambda share: share * F.col("n_words") + 1e-9  # noqa: E731  a share that is a whole number of words is allowed
    good = (F.col("n_covered") <= most(max_covered)) & (F.col("longest_repeat") <= most(max_longest))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & good)
