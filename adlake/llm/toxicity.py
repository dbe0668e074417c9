"""Toxicity scores by a bidirectional gated recurrent network in numpy."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.shared import add_columns, chunks

WORD = re.compile(r"\w+")
LONGEST = 64  # characters of a word; a longer run is overlapping pieces of so many
WINDOW = 16  # words
STRIDE = 8  # so windows overlap by half
SAMPLE_CHARS = 20_000_000  # of the texts of one label that are learned from
WORD_SIZE = 8
CHAR_SIZE = 6
CHAR_BITS = 12  # of a trigram's bucket
HIDDEN = 8
BATCH_WORDS = 1 << 16
KNOWN_WORDS = 400_000  # in a task's table of gate inputs; some 120 MB


@dataclass
class Recurrent:
    """Word and character inputs, a gated unit each way, attention, a logit.

    A word's input is its own vector (one shared vector for words not in the
    vocabulary) beside the mean vector of its character trigrams.
    """

    vocabulary: dict[str, int]  # from 2 on; 0 pads, 1 is any other word
    p: dict[str, np.ndarray]

    def inputs(self, words: list[str]) -> np.ndarray:
        """What each word gives to the gates of both directions."""
        own = self.p["words"][[self.vocabulary.get(word, 1) for word in words]]
        chars = gram_means(self.p["chars"], *trigrams(words))
        x = np.concatenate([own, chars], axis=1).astype(np.float32)
        return np.stack([x @ self.p["w_forward"] + self.p["b_forward"], x @ self.p["w_backward"] + self.p["b_backward"]])


def words_of(text: str) -> list[str]:
    """The words of a text in lower case.

    A run of over ``LONGEST`` characters, as of text without blanks, stands as
    pieces that overlap by half and cover it whole.
    """
    runs = WORD.findall(text.lower())
    if max(map(len, runs), default=0) <= LONGEST:
        return runs
    step = LONGEST // 2
    return [run[at : at + LONGEST] for run in runs for at in range(0, max(1, len(run) - step), step if len(run) > LONGEST else len(run))]


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of all marked words, and where each starts."""
    marked = [b"<%b>" % word.encode("utf-8", "surrogatepass") for word in words]
    sizes = np.array([len(word) for word in marked], np.int64)
    flat = np.frombuffer(b"".join(marked) + b"  ", np.uint8).astype(np.uint32)
    mixed = (flat[:-2] * np.uint32(961) + flat[1:-1] * np.uint32(31) + flat[2:]) * np.uint32(0x9E3779B1)
    ends = np.cumsum(sizes)
    inside = np.ones(len(mixed), bool)
    inside[ends - 1] = inside[ends - 2] = False  # those that would run over a word's end
    starts = np.concatenate([[0], np.cumsum(sizes - 2)[:-1]])
    return (mixed[inside] >> np.uint32(32 - CHAR_BITS)).astype(np.int64), starts


def gram_means(table: np.ndarray, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(table[grams], starts) / np.diff(np.append(starts, len(grams)))[:, None]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


def window_places(count: int) -> np.ndarray:
    """The word numbers in each window of a text of so many words; -1 pads."""
    starts = np.arange(0, max(1, count - WINDOW + STRIDE), STRIDE)
    at = starts[:, None] + np.arange(WINDOW)
    at[at >= count] = -1
    return at


def unit(gates: np.ndarray, recurrent: np.ndarray, steps: range, present: np.ndarray, keep: list | None = None) -> np.ndarray:
    """One direction over all windows at once; returns every state.

    gates: (window, step, 3 * HIDDEN) from the inputs: update, reset, candidate.
    A padded place leaves the state as it was.
    """
    n = len(gates)
    state = np.zeros((n, HIDDEN), np.float32)
    states = np.zeros((n, WINDOW, HIDDEN), np.float32)
    for t in steps:
        here = state @ recurrent
        update_reset = sigmoid(gates[:, t, : 2 * HIDDEN] + here[:, : 2 * HIDDEN])
        update, reset = update_reset[:, :HIDDEN], update_reset[:, HIDDEN:]
        candidate = np.tanh(gates[:, t, 2 * HIDDEN :] + reset * here[:, 2 * HIDDEN :])
        moved = update * (candidate - state) * present[:, t, None]
        if keep is not None:
            keep.append((t, state, update, reset, candidate, here[:, 2 * HIDDEN :]))
        state = state + moved
        states[:, t] = state
    return states


def window_logits(p: dict[str, np.ndarray], gates: np.ndarray, present: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """gates: (direction, window, step, 3 * HIDDEN)."""
    kept: tuple[list, list] | tuple[None, None] = ([], []) if keep is not None else (None, None)
    forward = unit(gates[0], p["u_forward"], range(WINDOW), present, kept[0])
    backward = unit(gates[1], p["u_backward"], range(WINDOW - 1, -1, -1), present, kept[1])
    states = np.concatenate([forward, backward], axis=2)
    energy = states @ p["attention"]
    energy = np.where(present > 0, energy - energy.max(axis=1, keepdims=True), -60)
    share = np.exp(energy)
    share /= share.sum(axis=1, keepdims=True)
    pooled = (share[:, None] @ states)[:, 0]
    if keep is not None:
        keep.update(states=states, share=share, pooled=pooled, kept=kept)
    return pooled @ p["out"] + p["out_bias"]


def train(texts: list[str], labels: list[int], least_epochs: int = 4, least_steps: int = 800, batch: int = 16, rate: float = 0.01, seed: int = 11, least_texts: int = 4) -> Recurrent:
    """Fits the network with Adam on labelled texts.

    A text's logit is that of its highest window, so the slope of a text passes
    through that window alone: it may be the only one that earns the label.
    """
    split = [words_of(text) for text in texts]
    seen: dict[str, int] = {}
    for words in {tuple(words) for words in split}:
        for word in set(words):
            seen[word] = seen.get(word, 0) + 1
    vocabulary = {word: at + 2 for at, word in enumerate(sorted(word for word, count in seen.items() if count >= least_texts))}
    random = np.random.default_rng(seed)
    size, gates = WORD_SIZE + CHAR_SIZE, 3 * HIDDEN
    p = {
        "words": random.normal(0, 0.3, (len(vocabulary) + 2, WORD_SIZE)),
        "chars": random.normal(0, 0.3, (1 << CHAR_BITS, CHAR_SIZE)),
        **{f"w_{side}": random.normal(0, 0.3, (size, gates)) for side in ("forward", "backward")},
        **{f"b_{side}": np.zeros(gates) for side in ("forward", "backward")},
        **{f"u_{side}": random.normal(0, 0.3, (HIDDEN, gates)) for side in ("forward", "backward")},
        "attention": random.normal(0, 0.3, 2 * HIDDEN),
        "out": random.normal(0, 0.3, 2 * HIDDEN),
        "out_bias": np.full((), -1.0),
    }
    p = {name: np.asarray(value, np.float32) for name, value in p.items()}
    moments = {name: [np.zeros_like(value), np.zeros_like(value)] for name, value in p.items()}
    all_words = sorted({word for words in split for word in words})
    number = {word: at for at, word in enumerate(all_words)}
    coded = [np.array([number[word] for word in words], np.int64) for words in split]
    word_ids = np.array([vocabulary.get(word, 1) for word in all_words], np.int64)
    gram_ids, gram_starts = trigrams(all_words) if all_words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    grams = np.split(gram_ids, gram_starts[1:])
    y_all = np.array(labels, np.float32)
    usable = [at for at, words in enumerate(split) if words]
    step, epochs = 0, max(least_epochs, -(-least_steps * batch // max(1, len(usable))))
    for epoch in range(epochs):
        order = random.permutation(usable)
        speed = rate * (1 - epoch / epochs)
        for at in range(0, len(order), batch):
            rows, step = order[at : at + batch], step + 1
            slopes = _slopes(p, [coded[row] for row in rows], y_all[rows], word_ids, grams, random)
            for name, slope in slopes.items():
                first, second = moments[name]
                where = ...
                if isinstance(slope, tuple):  # rows of a table
                    where, slope = slope
                first[where] += 0.1 * (slope - first[where])
                second[where] += 0.001 * (slope * slope - second[where])
                p[name][where] -= speed * (first[where] / (1 - 0.9**step)) / (np.sqrt(second[where] / (1 - 0.999**step)) + 1e-6)
    return Recurrent(vocabulary, p)


def _slopes(p, coded, y, word_ids, grams, random) -> dict:
    places = [window_places(len(words)) for words in coded]
    owner = np.repeat(np.arange(len(coded)), [len(w) for w in places])
    flat = np.concatenate([np.where(w >= 0, words[w], -1) for w, words in zip(places, coded)])
    present = (flat >= 0).astype(np.float32)
    distinct, inverse = np.unique(np.maximum(flat, 0), return_inverse=True)
    inverse = inverse.reshape(flat.shape)
    ids = word_ids[distinct].copy()
    # Now and then a word is taken as unknown, so that its characters count too.
    ids[random.random(len(ids)) < 0.15] = 1
    own = [grams[word] for word in distinct]
    sizes = np.array([len(g) for g in own])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    x = np.concatenate([p["words"][ids], gram_means(p["chars"], np.concatenate(own), starts)], axis=1).astype(np.float32)
    sides = ("forward", "backward")
    gates = np.stack([x @ p[f"w_{side}"] + p[f"b_{side}"] for side in sides])
    logits = window_logits(p, gates[:, inverse], present)
    # The highest window of each text.
    top = np.lexsort((logits, owner))
    top = top[np.flatnonzero(np.diff(np.append(owner[top], -1)))]
    inverse, present = inverse[top], present[top]
    keep: dict = {}
    logits = window_logits(p, gates[:, inverse], present, keep)
    error = (sigmoid(logits) - y) * np.where(y > 0, 2, 1) / len(y)
    states, share, pooled = keep["states"], keep["share"], keep["pooled"]
    out = {"out": pooled.T @ error, "out_bias": error.sum()}
    d_pooled = error[:, None] * p["out"]
    d_share = (states @ d_pooled[:, :, None])[:, :, 0]
    d_energy = share * (d_share - (share * d_share).sum(axis=1, keepdims=True)) * present
    out["attention"] = np.einsum("nth,nt->h", states, d_energy)
    d_states = share[:, :, None] * d_pooled[:, None] + d_energy[:, :, None] * p["attention"]
    d_x = np.zeros_like(x)
    for number, side in enumerate(sides):
        own_states = d_states[:, :, number * HIDDEN : (number + 1) * HIDDEN]
        u, d_u = p[f"u_{side}"], np.zeros_like(p[f"u_{side}"])
        d_gates = np.zeros((len(inverse), WINDOW, 3 * HIDDEN), np.float32)
        d_state = np.zeros((len(inverse), HIDDEN), np.float32)
        for t, state, update, reset, candidate, here in reversed(keep["kept"][number]):
            d_state = d_state + own_states[:, t]
            d_moved = d_state * present[:, t, None]
            d_candidate = d_moved * update * (1 - candidate**2)
            d_update = d_moved * (candidate - state) * update * (1 - update)
            d_reset = d_candidate * here * reset * (1 - reset)
            d_gates[:, t] = np.concatenate([d_update, d_reset, d_candidate], axis=1)
            d_here = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
            d_u += state.T @ d_here
            d_state = d_state - d_moved * update + d_here @ u.T
        out[f"u_{side}"] = d_u
        per_word = np.zeros((len(x), 3 * HIDDEN), np.float32)
        np.add.at(per_word, inverse.ravel(), (d_gates * present[:, :, None]).reshape(-1, 3 * HIDDEN))
        out[f"w_{side}"], out[f"b_{side}"] = x.T @ per_word, per_word.sum(axis=0)
        d_x += per_word @ p[f"w_{side}"].T
    used = np.flatnonzero(np.abs(d_x).sum(axis=1))
    for name, rows, slope in (
        ("words", ids[used], d_x[used, :WORD_SIZE]),
        ("chars", np.concatenate([own[at] for at in used] or [np.zeros(0, np.int64)]), np.repeat(d_x[used, WORD_SIZE:] / sizes[used, None], sizes[used], axis=0)),
    ):
        table, back = np.unique(rows, return_inverse=True)
        total = np.zeros((len(table), slope.shape[1]), np.float32)
        np.add.at(total, back, slope)
        out[name] = (table, total)
    return out


class Scorer:
    """The network in one task, with the gate inputs of the words met so far."""

    def __init__(self, network: Recurrent):
        self.network = network
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.gates = np.zeros((2, 1024, 3 * HIDDEN), np.float32)
        self.free = float(sigmoid(self.network.p["out_bias"]))

    def _numbers(self, words: list[str]) -> np.ndarray:
        numbers = list(map(self.known.get, words))
        if None in numbers:
            if len(self.known) > KNOWN_WORDS:
                self._forget()
            new = list(dict.fromkeys(word for word in words if word not in self.known))
            start = len(self.known)
            self.known.update(zip(new, range(start, start + len(new))))
            while self.gates.shape[1] < len(self.known):
                self.gates = np.concatenate([self.gates, np.zeros_like(self.gates)], axis=1)
            self.gates[:, start : len(self.known)] = self.network.inputs(new)
            numbers = list(map(self.known.__getitem__, words))
        return np.array(numbers, np.int32)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Each text's highest window; a text without a word has the base score."""
        found = np.full(len(texts), self.free)
        split = [words_of(text) for text in texts]
        for part in chunks([len(words) for words in split], BATCH_WORDS):
            counts = [len(words) for words in split[part]]
            # A change of the table's rows must not come between look-up and use.
            numbers = self._numbers([word for words in split[part] for word in words])
            at, tops, owners, first = [], [], [], 0
            for own, count in enumerate(counts):
                if count:
                    places = window_places(count)
                    at.append(np.where(places >= 0, places + first, -1))
                    owners.append(len(places))
                    tops.append(part.start + own)
                first += count
            if not tops:
                continue
            at = np.concatenate(at)
            starts = np.concatenate([[0], np.cumsum(owners)[:-1]])
            logits = np.empty(len(at), np.float32)
            for rows in chunks([WINDOW] * len(at), 1 << 14):
                inside = at[rows]
                gates = self.gates[:, numbers[np.maximum(inside, 0)]]
                logits[rows] = window_logits(self.network.p, gates, (inside >= 0).astype(np.float32))
            found[tops] = sigmoid(np.maximum.reduceat(logits, starts))
        return found


def training_sample(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = 2000, chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """Labelled whole texts, about ``rows`` of each label.

    Rows are drawn by a hash of their id, the same on every run. Of each label
    they are taken in the order of that hash until ``chars`` characters are
    full, so the driver gets a bounded number of bytes, and texts of any length.
    """
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {row["toxic"]: row["count"] for row in marked.groupBy("toxic").count().collect()}
    if set(counts) != {0, 1}:
        return []
    share = F.when(F.col("toxic") == 1, min(1.0, rows / counts[1])).otherwise(min(1.0, rows / counts[0]))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    drawn = marked.withColumn("draw", draw).where(F.col("draw") < share * (1 << 20)).orderBy("draw", "doc_id").limit(3 * rows)
    texts = docs.where(learn & F.col("text").isNotNull()).select("doc_id", "text")
    # The drawn ids are bounded by ``rows``; only they are sent to the scan.
    found = texts.join(F.broadcast(drawn), "doc_id")
    order = Window.partitionBy("toxic").orderBy("draw", "doc_id", F.xxhash64("text"))
    taken = found.withColumns({"upto": F.sum(F.length("text")).over(order), "at": F.row_number().over(order)})
    kept = taken.where((F.col("upto") <= chars) & (F.col("at") <= 2 * rows)).select("text", "toxic").collect()
    return sorted((row["text"], row["toxic"]) for row in kept)


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = 2000) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (score at least 0.5).

    Learns from the whole texts of a bounded sample of the labelled rows where
    ``learn``, a condition on doc_id, holds; the score of a text is that of its
    highest window, over all overlapping windows of the whole text; a word of
    over ``LONGEST`` characters counts as overlapping pieces. A null or
    empty text and one without a word get the score of no evidence. Without
    labels of both kinds every score is 0. Equal texts get equal scores;
    repeated rows, null ids and other columns pass through.
    """
    sample = training_sample(docs, labels, learn, rows)
    network = train([text for text, _ in sample], [label for _, label in sample]) if sample else None
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def start():
        scorer = Scorer(shared.value) if shared.value else None

        def run(texts: list[str | None]) -> list:
            score = scorer.scores([text or "" for text in texts]) if scorer else np.zeros(len(texts))
            return [score, (score >= 0.5).astype(np.int32)]

        return run

    return add_columns(docs, "text", {"score": "double", "predicted": "int"}, start)
