"""Token counts by a public tokenizer's library: only lengths leave the tasks."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.shared import chunks, kept, pieces_of

BATCH_BYTES = 1 << 20  # of text given to the library at once
PIECE_CHARS = 1 << 16  # a longer text is split

# No match of the vocabulary's pattern holds a character that is not white space
# and then a blank or line end, and no special string holds either; nothing to
# the left of such a place depends on what follows it.
SAFE_BOUNDARY = re.compile(r"(?<=[A-Za-z0-9.,;:!?])(?=[ \n])")


def split_safely(text: str, boundary: re.Pattern | None, size: int = PIECE_CHARS) -> list[str]:
    """The text in pieces of ``size`` characters, each up to the next safe
    boundary; whole where there is none, however long that is."""
    if boundary is None or len(text) <= size:
        return [text]
    out, start = [], 0
    while len(text) - start > size and (found := boundary.search(text, start + size)):
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]]


def _is_byte_level(content: str) -> bool:
    """Whether the safe boundary holds: byte-level pieces by the built-in
    pattern, nothing rewritten before it, no special string that takes the
    white space around it."""
    kind = json.loads(content)
    splitter = kind.get("pre_tokenizer") or {}
    plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space")
    tight = all(not re.search(r"\s", t["content"]) and not t["lstrip"] and not t["rstrip"] for t in kind.get("added_tokens", []))
    return bool(plain and tight and not kind.get("normalizer"))


def load_counter(path: str, content: bytes) -> tuple[Callable[[list[str]], list[int]], re.Pattern | None]:
    """A function from texts to their token counts, and where texts may be cut.

    ``.json`` goes to the tokenizers library, ``.model`` to sentencepiece. Texts
    are cut only for byte-level vocabularies, where it changes no token.
    """
    if path.endswith(".model"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda texts: list(map(len, processor.encode(texts, num_threads=1))), None
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import tokenizers

    tokenizer = tokenizers.Tokenizer.from_str(content.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def count(texts: list[str]) -> list[int]:
        return list(map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False)))

    return count, SAFE_BOUNDARY if _is_byte_level(content.decode()) else None


def count_texts(texts: list[str | None], count: Callable[[list[str]], list[int]], boundary: re.Pattern | None) -> list[int]:
    """Tokens of each text; the library gets batches of about equal bytes."""
    parts, owners = [], []
    for at, text in enumerate(texts):
        for part in split_safely(text, boundary) if text else ():
            parts.append(part)
            owners.append(at)
    totals = [0] * len(texts)
    for batch in chunks(map(len, parts), BATCH_BYTES):
        for owner, found in zip(owners[batch], count(parts[batch])):
            totals[owner] += found
    return totals


def token_count(docs: DataFrame, path: str, text: str = "text") -> Column:
    """The number of tokens of a text column, as the library of the vocabulary
    at ``path`` gives it: nothing added, special strings handled as its default,
    nothing cut off. A null or empty text has none.

    The file is read on the driver and broadcast; its size is that of a
    vocabulary.
    """
    with open(path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast((os.path.basename(path), file.read()))

    @F.arrow_udf("long")
    def lengths(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        name, content = shared.value
        counter = kept(f"{name}-{hash(content)}", lambda: load_counter(name, content))
        for array in arrays:
            found = [count_texts(part.to_pylist(), *counter) for part in pieces_of(array)]
            yield pa.array([value for part in found for value in part], pa.int64())

    return lengths(F.col(text))


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit`` to the documents.

    ``n_bytes`` is the UTF-8 length of the text, 0 for null, and ``over_limit``
    tells whether it has more than ``limit`` tokens. Rows are independent:
    repeated rows, null ids and other columns pass through; columns of the added
    names are replaced. Only the text goes to Python and only its length comes
    back.
    """
    own = docs.drop("n_bytes", "n_tokens", "over_limit")
    counted = own.withColumns({"n_bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"), "n_tokens": token_count(own, path)})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
