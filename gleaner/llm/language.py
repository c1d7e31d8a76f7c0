"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import Memo, crc_fold, per_text

LONGEST = 24  # bytes the network reads at a time; longer words are cut into such pieces, all of them read
BATCH = 2048  # pieces the network reads side by side


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Two gated recurrent layers, one per direction, over embedded bytes; class scores at every position."""

    def __init__(self, n_classes: int, hidden: int = 12, width: int = 8, seed: int = 7):
        draw = np.random.default_rng(seed)
        shape = lambda *s: (draw.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.hidden = hidden
        self.p = {"embed": shape(256, width) * 4, "out": shape(2 * hidden, n_classes), "out_b": np.zeros(n_classes, np.float32)}
        for d in "fb":
            self.p |= {f"{d}_x": shape(width, 3 * hidden), f"{d}_h": shape(hidden, 3 * hidden), f"{d}_b": np.zeros(3 * hidden, np.float32)}

    def _direction(self, d: str, x: np.ndarray, live: np.ndarray, keep: bool):
        """States along one direction. x: steps, batch, width; live: 1 where the step has a byte."""
        h, n = self.hidden, x.shape[1]
        state, states, saved = np.zeros((n, h), np.float32), [], []
        inputs = x @ self.p[f"{d}_x"] + self.p[f"{d}_b"]
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            back = state @ self.p[f"{d}_h"]
            gates = _sigmoid(inputs[t, :, : 2 * h] + back[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            new = np.tanh(inputs[t, :, 2 * h :] + reset * back[:, 2 * h :])
            on = live[t][:, None]
            if keep:
                saved.append((t, state, update, reset, new, back[:, 2 * h :], on))
            state = on * (update * state + (1 - update) * new) + (1 - on) * state
            states.append(state)
        return np.stack(states if d == "f" else states[::-1]), saved

    def positions(self, codes: np.ndarray, live: np.ndarray, keep: bool = False):
        """Class probabilities of every position. codes, live: steps, batch."""
        x = self.p["embed"][codes]
        f, saved_f = self._direction("f", x, live, keep)
        b, saved_b = self._direction("b", x, live, keep)
        both = np.concatenate([f, b], axis=2)
        scores = both @ self.p["out"] + self.p["out_b"]
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        return scores / scores.sum(axis=2, keepdims=True), (x, both, saved_f, saved_b)

    def step(self, codes, live, label, weight, rate: float, memory: dict) -> float:
        """One step of gradient descent (Adam) by backpropagation through time; every position learns the label."""
        probs, (x, both, saved_f, saved_b) = self.positions(codes, live, True)
        n_live = (live * weight).sum()
        target = np.zeros(probs.shape[1:], np.float32)
        target[np.arange(len(label)), label] = 1
        scale = (live * weight)[:, :, None] / n_live
        loss = float(-(np.log((probs * target).sum(axis=2) + 1e-9) * scale[:, :, 0]).sum())
        d_scores = (probs - target) * scale
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["out"] = np.einsum("tnh,tnc->hc", both, d_scores)
        grads["out_b"] = d_scores.sum(axis=(0, 1))
        d_both = d_scores @ self.p["out"].T
        d_x = np.zeros_like(x)
        h = self.hidden
        for d, saved, d_states in (("f", saved_f, d_both[:, :, :h]), ("b", saved_b, d_both[:, :, h:])):
            carry = np.zeros_like(d_states[0])
            for t, before, update, reset, new, back_new, on in reversed(saved):
                total = d_states[t] + carry
                moved = total * on
                d_new = moved * (1 - update) * (1 - new * new)
                d_update = moved * (before - new) * update * (1 - update)
                d_reset = d_new * back_new * reset * (1 - reset)
                d_in = np.concatenate([d_update, d_reset, d_new], axis=1)
                d_back = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
                grads[f"{d}_x"] += x[t].T @ d_in
                grads[f"{d}_b"] += d_in.sum(axis=0)
                grads[f"{d}_h"] += before.T @ d_back
                d_x[t] += d_in @ self.p[f"{d}_x"].T
                carry = d_back @ self.p[f"{d}_h"].T + moved * update + total * (1 - on)
        np.add.at(grads["embed"], codes.ravel(), d_x.reshape(-1, x.shape[2]))
        memory["t"] = k = memory.get("t", 0) + 1
        for name, g in grads.items():
            m, v = memory.get(name, (0, 0))
            memory[name] = m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            self.p[name] = (self.p[name] - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
        return loss


def packed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and live marks (steps, batch) of words, each after a space."""
    steps = max(map(len, words)) + 1
    codes = np.frombuffer(b"".join(b" " + w.ljust(steps - 1, b"\0") for w in words), np.uint8).reshape(len(words), steps).T
    sizes = np.array([len(w) + 1 for w in words])
    return codes, (np.arange(steps)[:, None] < sizes).astype(np.float32)


def pieces(word: bytes) -> list[bytes]:
    return [word[i : i + LONGEST] for i in range(0, len(word), LONGEST)]


def train(samples: list[tuple[str, bytes]], epochs: int = 4, seed: int = 7) -> tuple[list[str], Network | None]:
    """The languages and the network; samples: (language, word). Every language weighs the same."""
    names = sorted({lang for lang, _ in samples})
    if not names:
        return [], None
    place = {lang: i for i, lang in enumerate(names)}
    flat = sorted((place[lang], piece) for lang, word in samples for piece in pieces(word))
    label = np.array([k for k, _ in flat])
    share = np.bincount(label, minlength=len(names))
    weight = (len(label) / len(names) / share)[label].astype(np.float32)
    network, memory, draw = Network(len(names), seed=seed), {}, np.random.default_rng(seed)
    for epoch in range(epochs):
        order = draw.permutation(len(flat))
        for i in range(0, len(order), 512):
            rows = order[i : i + 512]
            codes, live = packed([flat[r][1] for r in rows])
            network.step(codes, live, label[rows], weight[rows], 0.01 if epoch < epochs - 1 else 0.003, memory)
    return names, network


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    held_out: int = 1,
    docs_per_lang: int = 300,
    words_per_doc: int = 40,
    max_docs: int = 12_000,
) -> tuple[list[str], Network | None]:
    """Train on a bounded sample: per language the ``docs_per_lang`` rows that come first by a hash of the id, at most
    ``max_docs`` in all, and from each ``words_per_doc`` words spread over its whole text. Rows of the held-out fold and
    rows without a language or text never enter. Only about three times the rows wanted are ranked. No such rows: no
    languages.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).cast("string").alias("_t")
    ).filter((crc_fold(F.col("_id")) != held_out) & F.col("_lang").isNotNull() & F.col("_t").isNotNull())
    sizes = rows.groupBy("_lang").agg(F.count("*").alias("_n"))  # one row per language
    place = F.shiftrightunsigned(F.xxhash64("_id"), 11) / float(1 << 53)
    near = rows.select("_id", "_lang").join(F.broadcast(sizes), "_lang").filter(place < (3 * docs_per_lang + 100) / F.col("_n"))
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id")
    ranked = near.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= docs_per_lang)
    chosen = ranked.orderBy("_k", "_lang", "_id").limit(max_docs).select("_id", "_lang")
    sampled = rows.join(F.broadcast(chosen.distinct()), ["_id", "_lang"], "left_semi")  # at most max_docs ids
    words = F.expr(
        f"""transform(sequence(0, {words_per_doc - 1}), i -> element_at(w, cast(1 + size(w) * i div {words_per_doc} as int)))"""
    )
    listed = (
        sampled.withColumn("w", F.split(F.trim(F.col("_t")), r"[\x20\x09-\x0D]+"))
        .select("_lang", "_id", words.alias("w")).orderBy("_lang", "_id", "w").limit(2 * max_docs).collect()
    )
    return train([(r["_lang"], w.encode()) for r in listed for w in r["w"] if w])


def _labels(names: list[str], network: Network | None):
    def start():
        memo = Memo()

        def learn(words: list[bytes]) -> None:
            """Sums over the positions of each word, and the number of positions."""
            cut = sorted((piece, k) for k, w in enumerate(words) for piece in pieces(w))
            cut.sort(key=lambda x: len(x[0]))
            sums = np.zeros((len(words), len(names) + 1))
            for i in range(0, len(cut), BATCH):
                part = cut[i : i + BATCH]
                codes, live = packed([w for w, _ in part])
                probs, _ = network.positions(codes, live)
                at = [k for _, k in part]
                np.add.at(sums[:, :-1], at, (probs * live[:, :, None]).sum(axis=0))
                np.add.at(sums[:, -1], at, live.sum(axis=0))
            width, held = 4 * (len(names) + 1), sums.astype(np.float32).tobytes()
            memo.update((w, held[k * width : (k + 1) * width]) for k, w in enumerate(words))

        def run(texts: list[bytes]) -> list:
            memo.room()
            listed = [t.split() for t in texts]
            unknown = list(set(chain.from_iterable(listed)).difference(memo))
            if unknown and network:
                learn(unknown)
            langs, scores = [], []
            for text, words in zip(texts, listed, strict=True):
                if not network or not words or not any(map(str.isalpha, text.decode("utf-8", "replace"))):
                    langs.append("und")
                    scores.append(0.0)
                    continue
                rows = np.frombuffer(b"".join(map(memo.__getitem__, words)), np.float32).reshape(-1, len(names) + 1)
                pooled = rows.sum(axis=0, dtype=np.float64)
                best = int(pooled[:-1].argmax())
                langs.append(names[best])
                scores.append(min(1.0, float(pooled[best] / pooled[-1])))
            return [langs, scores]

        return run

    return start


def identify(
    docs: DataFrame, model: tuple[list[str], Network | None], id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``lang_pred`` and ``score`` of every row beside the id (or the ``keep`` columns).

    The network labels every byte of the whole text, a word at a time, so that words met before need no second pass; the
    document takes the mean of the probabilities of its positions. Null texts and texts without a letter (of a Unicode
    category L; digits such as a half or a circled one are none) are ``und`` with score 0, as is everything if no language was
    learned. Equal means go to the language first by name. Repeated rows get a row each, empty tables none, texts of any
    length are read whole.
    """
    fields = [("lang_pred", T.StringType(), pa.string()), ("score", T.DoubleType(), pa.float64())]
    return per_text(docs, text_col, keep or [id_col], fields, _labels(*model))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **bounds) -> DataFrame:
    """Train on the folds that aren't held out, then label every row."""
    return identify(docs, fit(docs, id_col, text_col, lang_col, **bounds), id_col, text_col)
