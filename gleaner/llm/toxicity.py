"""Toxicity by a weighted finite-state grammar over clauses, with lexicon and weights learned from labels."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import UPPER_TO_LOWER, Memo, crc_fold, first_by_hash, per_text
from gleaner.session import written

#: Starting word lists of the grammar.
INSULTS = "idiot moron stupid dumb loser scum trash pathetic worthless disgusting bastard imbecile fool jerk dumm blöd crétin imbécile estúpido".split()
THREATS = "kill hurt beat destroy murder strangle stab shoot umbringen töten tuer matar".split()
INTENTS = "will shall gonna must should werde vais voy".split()
TARGETS = "you your youre u he she they him her them his their this these those du ihr tu vous usted ustedes".split()
NEGATIONS = "not no never neither nor without nicht kein keine pas jamais ni nunca sin".split()
REPORTS = "said says say wrote writes called calls quoted claims claimed alleged reported sagte dit dijo".split()

WORD = re.compile(rb"[a-z0-9\x80-\xff]+|[.!?;:\n]")
ENDS = frozenset((b".", b"!", b"?", b";", b":", b"\n"))
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
TAGS = ("aimed", "negated", "reported", "threat")
#: Weights of a text before learning: constant, strength of its matches, strength under each tag, length of the text.
START = (-2.5, 1.0, 0.3, -0.9, -0.8, 0.3, -0.3)
SEED_STRENGTH = 3.0
STEMS = range(3, 11)  # lengths of the word beginnings the lexicon may hold


class Transducer:
    """A finite-state machine from word classes to tags: ``table[state][symbol]`` is (next state, tags of this word)."""

    def __init__(self, table: dict):
        self.table = table

    def step(self, state, symbol):
        moves = self.table[state]
        return moves.get(symbol) or moves["*"]


class Composed:
    """Machines that read the same words side by side; states are pairs, tags are unions, moves are built when first met."""

    def __init__(self, left, right):
        self.left, self.right, self.moves = left, right, {}

    def step(self, state, symbol):
        found = self.moves.get((state, symbol))
        if not found:
            a, first = self.left.step(state[0], symbol)
            b, second = self.right.step(state[1], symbol)
            found = self.moves[state, symbol] = ((a, b), first | second)
        return found


def _scope(opener: str, reach: int, tag: str, on: tuple[str, ...], forget_at_end: bool = True) -> Transducer:
    """Tags words of class ``on`` up to ``reach`` words after an opener; a clause end closes the scope."""
    none: frozenset = frozenset()
    table = {}
    for left in range(reach + 1):
        after = max(left - 1, 0)
        table[left] = {"*": (after, none), opener: (reach, none), "end": (0 if forget_at_end else after, none)}
        table[left] |= {symbol: (after, frozenset([tag]) if left else none) for symbol in on}
    return Transducer(table)


def grammar() -> tuple[Composed, tuple]:
    """Insult and threat words, aimed at someone, meant, negated or reported: the machine and its start state."""
    said = _scope("report", 12, "reported", ("insult", "threat"))
    meant = _scope("intent", 3, "threat", ("threat",))
    return Composed(Composed(_scope("target", 4, "aimed", ("insult", "threat")), _scope("negation", 2, "negated", ("insult", "threat"))), Composed(said, meant)), ((0, 0), (0, 0))


class Lexicon:
    """Class and strength of a word: fixed lists by the whole word, insults by the longest known beginning."""

    def __init__(self, stems: dict[str, float]):
        self.stems = {w.encode(): x for w, x in stems.items()}
        self.lengths = sorted({len(w) for w in self.stems}, reverse=True)
        self.fixed: dict[bytes, str] = {}
        for words, kind in ((TARGETS, "target"), (NEGATIONS, "negation"), (REPORTS, "report"), (INTENTS, "intent"), (THREATS, "threat")):
            self.fixed |= {w.encode(): kind for w in words}
        self.memo = Memo()

    def stem(self, word: bytes) -> bytes | None:
        return next((word[:n] for n in self.lengths if word[:n] in self.stems), None) if word not in self.fixed else None

    def look(self, word: bytes) -> tuple[str, float]:
        found = self.memo.get(word)
        if found is None:
            self.memo.room()
            stem = self.stem(word)
            kind = "insult" if stem else self.fixed.get(word, "*")
            found = self.memo[word] = (kind, self.stems[stem] if stem else SEED_STRENGTH if kind == "threat" else 0.0)
        return found


def features(text: bytes, lexicon: Lexicon, machine: Composed, start: tuple) -> list[float] | None:
    """What a text gives the model, from its matched clauses: None without a match.

    In a clause the strongest match counts whole and further ones half. A threat word counts if it is meant or aimed.
    """
    state, clause, out, matched = start, [], np.zeros(len(START)), 0
    tokens = WORD.findall(text.translate(UPPER_TO_LOWER).replace(b"n't", b" not"))
    for token in [*tokens, b"."]:
        symbol, strength = ("end", 0.0) if token in ENDS else lexicon.look(token)
        state, tags = machine.step(state, symbol)
        if symbol == "insult" or symbol == "threat" and tags & {"threat", "aimed"}:
            clause.append((strength, tags))
        elif symbol == "end" and clause:
            clause.sort(key=lambda x: -x[0])
            for k, (strength, tags) in enumerate(clause):
                part = strength if not k else strength / 2
                out[1] += part
                out[2:6] += [part * (t in tags) for t in TAGS]
            matched += len(clause)
            clause = []
    if not matched:
        return None
    out[0], out[6] = 1.0, math.log1p(len(tokens) / 100)
    return out.tolist()


def score(found: list[float] | None, weights: np.ndarray, rest: float) -> float:
    if found is None:
        return rest
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(weights @ np.array(found))))))


class Model:
    """Word beginnings with strengths, weights of the features, and the rate of toxic texts without a match."""

    def __init__(self, stems: dict[str, float], weights: np.ndarray, rest: float):
        self.stems, self.weights, self.rest = stems, weights, rest


def _beginnings():
    def run(texts: list[bytes]) -> list:
        words = [{w for w in t.translate(LETTERS).decode("utf-8", "replace").split()} for t in texts]
        return [[sorted({w[:n] for w in listed for n in STEMS if n <= len(w)} | {w for w in listed if len(w) < STEMS[0]}) for listed in words]]

    return run


def _stem_rows(stems: dict[str, float]):
    def start():
        lexicon = Lexicon(stems)

        def run(texts: list[bytes]) -> list:
            return [[sorted({lexicon.stem(w).decode() for w in set(t.translate(LETTERS).split()) if lexicon.stem(w)}) for t in texts]]

        return run

    return start


def _feature_rows(stems: dict[str, float]):
    def start():
        lexicon, (machine, first) = Lexicon(stems), grammar()
        return lambda texts: [[features(x, lexicon, machine, first) for x in texts]]

    return start


def choose_stems(counts: list) -> dict[str, float]:
    """Beginnings for the lexicon. counts: (beginning, toxic texts, log odds), all telling.

    A longer beginning stands for the shorter one if it is in nearly all the same texts, or in a good part of them and far
    more telling; below a chosen one none is needed.
    """
    known = {w: (b, odds) for w, b, odds in counts}
    passed = set()
    for w, (b, odds) in known.items():
        for short in (w[:n] for n in range(1, len(w))):
            if short in known and (b >= 0.9 * known[short][0] or b >= 0.2 * known[short][0] and odds >= known[short][1] + 1):
                passed.add(short)
    chosen: dict[str, float] = {}
    for w, _, odds in sorted(counts, key=lambda x: (len(x[0]), x[0])):
        if w not in passed and not any(w[:n] in chosen for n in range(1, len(w))):
            chosen[w] = min(odds, 6.0)
    return chosen


def drop_passengers(stems: dict[str, float], rows: list[tuple[int, list[str]]]) -> dict[str, float]:
    """Without weak stems that toxic texts mostly hold beside a strong one: copies of a text share all its words.

    rows: label and stems found of each text of the sample.
    """
    strong = {w for w, odds in stems.items() if odds >= 4}
    all_, alone = Counter(), Counter()
    for toxic, found in rows:
        if toxic:
            all_.update(found)
            if strong.isdisjoint(found):
                alone.update(found)
    return {w: odds for w, odds in stems.items() if w in strong or 2 * alone[w] >= all_[w]}


def _learn_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression held to the starting weights by a Gaussian prior (Newton steps)."""
    weights = start = np.array(START)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - (weights - start)
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(START))
        weights = weights + np.clip(np.linalg.solve(bend, slope), -0.5, 0.5)
    return weights


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    held_out: int = 1,
    max_rows: int = 5_000,
    min_share: float = 0.02,
    min_odds: float = 6.0,
) -> Model:
    """Learn from at most ``max_rows`` labelled rows, first by a hash of the id, none from the held-out fold.

    The lexicon gets word beginnings that ``min_share`` of the toxic texts (and three) hold and whose odds there are
    ``min_odds`` times those elsewhere, so inflected forms share an entry; its strengths are the log odds. Without labels
    of both kinds the starting lists and weights stay. Null labels and texts don't enter.
    """
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic")).filter(
        F.col("toxic").isNotNull() & F.col("_id").isNotNull() & (crc_fold(F.col("_id")) != held_out)
    )
    chosen = first_by_hash(marked.groupBy("_id").agg(F.max("toxic").alias("toxic")), max_rows, "_id")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t")).filter(F.col("_t").isNotNull())
    sample = written(texts.join(F.broadcast(chosen), "_id").select("toxic", "_t").distinct(), "labelled")  # max_rows ids
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two labels
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    stems = dict.fromkeys(INSULTS, SEED_STRENGTH)
    if not bad or not good:
        return Model(stems, np.array(START), 0.01)
    words = per_text(sample, "_t", ["toxic"], [("w", T.ArrayType(T.StringType()), pa.list_(pa.string()))], _beginnings)
    counts = words.select("toxic", F.explode("w").alias("w")).groupBy("w").agg(
        F.sum("toxic").alias("b"), F.sum(1 - F.col("toxic")).alias("g")
    )
    odds = ((F.col("b") + 0.1) / (bad - F.col("b") + 0.1)) / ((F.col("g") + 0.1) / (good - F.col("g") + 0.1))
    strong = counts.filter((F.col("b") >= max(3, min_share * bad)) & (odds >= min_odds))  # at most 1 / min_share a word of a text
    learned = choose_stems([(r["w"], r["b"], r["o"]) for r in strong.select("w", "b", F.log(odds).alias("o")).collect()])
    held = per_text(sample, "_t", ["toxic"], [("w", T.ArrayType(T.StringType()), pa.list_(pa.string()))], _stem_rows(learned))
    stems |= drop_passengers(learned, [(r["toxic"], r["w"]) for r in held.collect()])  # at most max_rows
    found = per_text(sample, "_t", ["toxic"], [("x", T.ArrayType(T.DoubleType()), pa.list_(pa.float64()))], _feature_rows(stems))
    rows = found.collect()  # at most max_rows
    matched = [r for r in rows if r["x"] is not None]
    weights = _learn_weights(np.array([r["x"] for r in matched]).reshape(-1, len(START)), np.array([r["toxic"] for r in matched], float))
    others = [r["toxic"] for r in rows if r["x"] is None]
    return Model(stems, weights, min(0.3, (sum(others) + 0.5) / (len(others) + 10)))


def _scores(stems: dict[str, float], weights: np.ndarray, rest: float):
    def start():
        lexicon, (machine, first) = Lexicon(stems), grammar()

        def run(texts: list[bytes]) -> list:
            out = []
            for t in texts:
                seen = any(lexicon.look(w)[1] for w in set(t.translate(LETTERS).split()))
                out.append(score(features(t, lexicon, machine, first), weights, rest) if seen else rest)
            return [out]

        return run

    return start


def toxicity(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, keep: list[str] | None = None
) -> DataFrame:
    """``score`` (0 to 1) of every whole text and ``predicted`` (1 from the threshold on) beside the id or ``keep``.

    Null and empty texts get the score of texts without a match. Rows are scored one by one without a shuffle.
    """
    scored = per_text(docs, text_col, keep or [id_col], [("score", T.DoubleType(), pa.float64())], _scores(model.stems, model.weights, model.rest))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
