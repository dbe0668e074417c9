"""Language identification by a byte convolutional network in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.shared import add_columns, chunks, utf8

UNDETERMINED = "und"
SAMPLE_ROWS = 150_000  # of all languages together
WINDOW = 256  # bytes a window
WIDTHS = (2, 3, 4)  # bytes a filter spans
STRIDE = WINDOW - max(WIDTHS) + 1  # so each filter sees each place of a text once
FILTERS = 12  # of each width
EMBEDDING = 8
BATCH_BYTES = 1 << 18


@dataclass
class ByteNetwork:
    """Byte embedding, filters of several widths, max pooling, softmax."""

    languages: list[str]
    embedding: np.ndarray  # (256, EMBEDDING)
    kernel: np.ndarray  # (widest, EMBEDDING, filters); zero beyond a filter's width
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def taps(self) -> np.ndarray:
        """What each byte value adds to each filter, by its place in the filter."""
        return np.einsum("be,wef->wbf", self.embedding, self.kernel).astype(np.float32)

    def pair_tables(self) -> list[np.ndarray]:
        """The same for pairs of bytes: a filter of four bytes is two look-ups."""
        first, second, third, fourth = self.taps()
        return [
            (first[:, None] + second[None] + self.bias).reshape(65536, -1),
            (third[:, None] + fourth[None]).reshape(65536, -1),
        ]


def filter_mask() -> np.ndarray:
    """One where a filter has a weight: place in the filter by filter."""
    widths = np.repeat(WIDTHS, FILTERS)
    return (np.arange(max(WIDTHS))[:, None] < widths[None]).astype(np.float32)


def windows(text: bytes) -> np.ndarray:
    """All windows of a text, as rows of bytes; zeros after its end."""
    count = max(1, -(-(len(text) - max(WIDTHS) + 1) // STRIDE))
    padded = np.zeros((count - 1) * STRIDE + WINDOW, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (count, WINDOW), (STRIDE, 1))


def train(texts: list[bytes], labels: list[str], epochs: int = 8, batch: int = 48, rate: float = 0.01, seed: int = 7) -> ByteNetwork:
    """Fits the network with Adam on the windows of some labelled texts.

    A window counts by one over its language's windows, so that frequent
    languages don't outweigh rare ones. Every second window is cut to a random
    length: short texts occur as well.
    """
    languages = sorted(set(labels))
    own = [windows(text) for text in texts]
    x = np.concatenate(own)
    y = np.repeat([languages.index(label) for label in labels], [len(part) for part in own])
    random = np.random.default_rng(seed)
    count = len(WIDTHS) * FILTERS
    mask = filter_mask()[:, None]
    parameters = {
        "embedding": random.normal(0, 0.5, (256, EMBEDDING)),
        "kernel": random.normal(0, 0.25, (max(WIDTHS), EMBEDDING, count)) * mask,
        "bias": np.zeros(count),
        "out": random.normal(0, 0.2, (count, len(languages))),
        "out_bias": np.zeros(len(languages)),
    }
    parameters = {name: value.astype(np.float32) for name, value in parameters.items()}
    moments = {name: (np.zeros_like(value), np.zeros_like(value)) for name, value in parameters.items()}
    weight = (1 / np.maximum(np.bincount(y, minlength=len(languages)), 1)).astype(np.float32)
    weight *= len(y) / max(1, np.count_nonzero(np.bincount(y, minlength=len(languages))))
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(x))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            values, step = x[rows].copy(), step + 1
            lengths = np.where(random.random(len(rows)) < 0.5, WINDOW, random.integers(12, WINDOW, len(rows)))
            values[np.arange(WINDOW)[None] >= lengths[:, None]] = 0
            gradient = _gradient(parameters, values, y[rows], np.minimum(weight[y[rows]], 20), mask)
            for name, slope in gradient.items():
                first, second = moments[name]
                first += 0.1 * (slope - first)
                second += 0.001 * (slope * slope - second)
                parameters[name] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
    return ByteNetwork(languages=languages, **parameters)


def _gradient(p: dict[str, np.ndarray], values: np.ndarray, y: np.ndarray, weight: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
    rows = np.arange(len(values))
    embedded = p["embedding"][values]
    scores = sum(embedded[:, k : k + STRIDE] @ p["kernel"][k] for k in range(max(WIDTHS)))
    best = scores.argmax(axis=1)  # (window, filter): only there does a slope pass
    pooled = np.take_along_axis(scores, best[:, None], axis=1)[:, 0] + p["bias"]
    hidden = np.maximum(pooled, 0)
    logits = hidden @ p["out"] + p["out_bias"]
    odds = np.exp(logits - logits.max(axis=1, keepdims=True))
    odds /= odds.sum(axis=1, keepdims=True)
    odds[rows, y] -= 1
    odds *= (weight / len(values))[:, None]
    back = (odds @ p["out"].T) * (pooled > 0)
    kernel, table = np.zeros_like(p["kernel"]), np.zeros_like(p["embedding"])
    for k in range(max(WIDTHS)):
        at = values[rows[:, None], best + k]  # the bytes under each filter's best place
        kernel[k] = np.einsum("wf,wfe->ef", back, p["embedding"][at])
        np.add.at(table, at.ravel(), (back[:, :, None] * p["kernel"][k].T[None]).reshape(-1, EMBEDDING))
    return {"embedding": table, "kernel": kernel * mask, "bias": back.sum(axis=0), "out": hidden.T @ odds, "out_bias": odds.sum(axis=0)}


def window_log_odds(network: ByteNetwork, tables: list[np.ndarray], values: np.ndarray) -> np.ndarray:
    """Log-probability of each language for each window."""
    low, high = values[:, :-1], values[:, 1:]
    pairs = low.astype(np.int32) * 256 + high  # the pair at each place
    places = values.shape[1] - max(WIDTHS) + 1
    pooled = np.empty((len(values), network.bias.size), np.float32)
    for part in chunks([places] * len(values), 1 << 13):
        scores = tables[0][pairs[part, :places]]
        scores += tables[1][pairs[part, 2 : places + 2]]
        scores.max(axis=1, out=pooled[part])
    logits = np.maximum(pooled, 0) @ network.out + network.out_bias
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def predict(network: ByteNetwork, tables: list[np.ndarray], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Best language and its score for each text, over all its windows.

    The windows' log-probabilities are averaged; a last window counts by what
    it holds.
    """
    best, score = np.zeros(len(texts), int), np.zeros(len(texts))
    for part in chunks([max(len(text), WINDOW) for text in texts], BATCH_BYTES):
        own = [windows(text) for text in texts[part]]
        counts = np.array([len(w) for w in own])
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        odds = window_log_odds(network, tables, np.concatenate(own))
        share = np.ones(len(odds))
        share[starts + counts - 1] = [max(1, len(text) - (n - 1) * STRIDE) / WINDOW for text, n in zip(texts[part], counts)]
        mean = np.add.reduceat(odds * share[:, None], starts) / np.add.reduceat(share, starts)[:, None]
        odds = np.exp(mean - mean.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        best[part], score[part] = odds.argmax(axis=1), odds.max(axis=1)
    return best, score


def training_sample(docs: DataFrame, learn: Column, rows_per_language: int = 600, chars: int = 1200) -> list[tuple[str, str]]:
    """Labelled pieces of text: at most about ``rows_per_language`` of each.

    With many labels each gives fewer, but every label gives some, and all give
    about ``SAMPLE_ROWS``. Rows are taken by a hash of their text, so the sample
    is the same on every run, and each gives a piece of ``chars`` characters
    from a place that its hash decides.
    """
    known = docs.where(learn & F.col("lang").isNotNull())
    counts = known.groupBy("lang").count().collect()  # one row per label
    if not counts:
        return []
    rows_per_language = min(rows_per_language, max(4, SAMPLE_ROWS // len(counts)))
    share = F.create_map(*[F.lit(x) for row in counts for x in (row["lang"], min(1.0, rows_per_language / row["count"]))])
    drawn = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)
    place = F.pmod(F.xxhash64("text", F.lit(2)), F.greatest(F.length("text") - chars, F.lit(1))).cast("int") + 1
    pieces = known.where(F.col("text").isNotNull() & drawn).select("lang", F.substring("text", place, F.lit(chars)).alias("piece"))
    # Copies of one text are drawn together; the limit keeps the bound all the same.
    order = [F.xxhash64("piece"), "piece", "lang"]
    rows = pieces.distinct().orderBy(*order).limit(len(counts) * rows_per_language * 2).collect()
    return sorted((row["piece"], row["lang"]) for row in rows if has_letter(row["piece"]))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def identify(docs: DataFrame, learn: Column, rows_per_language: int = 600) -> DataFrame:
    """Adds ``lang_pred``, ``score`` (0 to 1) and ``lang_lift`` to each document.

    The network learns from ``text`` and non-null ``lang`` of a bounded sample
    of the rows where ``learn`` holds (see ``training_sample``); only the text
    takes part in a prediction, in all its windows. A null text or one without
    a letter is ``und`` with score 0, and so is every text when there is
    nothing to learn from. ``lang_lift`` is the score over that of chance, one
    over the number of learned languages. Equal texts get equal results; repeated rows, null
    ids and other columns pass through.
    """
    sample = training_sample(docs, learn, rows_per_language)
    network = train([utf8(text) for text, _ in sample], [lang for _, lang in sample]) if sample else None
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def start():
        model = shared.value
        tables = model.pair_tables() if model else None

        def run(texts: list[str | None]) -> list:
            lang, score = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
            told = [at for at, text in enumerate(texts) if model is not None and has_letter(text)]
            if told:
                best, found = predict(model, tables, [utf8(texts[at]) for at in told])
                lang[told], score[told] = np.array(model.languages, object)[best], found
            return [lang, score, score * (len(model.languages) if model else 0)]

        return run

    return add_columns(docs, "text", {"lang_pred": "string", "score": "double", "lang_lift": "double"}, start)
