"""Byte-level BPE encoding and decoding, with tree concatenation for long texts.

Texts up to a size are encoded in place. A longer one is halved until its parts are
short, the parts are encoded in parallel as rows of their own, and the token lists are
joined pairwise up the tree. A part ends before a lone space between two words if there
is one near: no token reaches over such a place, so lists are simply strung together.
Inside long unsplit text the cut may fall within a token. Then a window of tokens around
the join is encoded again, and grows until its first and last tokens are those that both
sides had. Neighbouring tokens that the encoder itself put side by side stay valid
neighbours, so agreement at both ends makes the joined list exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import keyed, slices

# The split pattern and the special token that belong to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256

# A text with more characters than this is encoded in parts of at most half of it.
LONG_CHARS = 1 << 16
# Tokens on either side of a join that must come out the same.
AGREEING = 2


class Codec:
    """Encoder and decoder of one vocabulary file of ranks; make one per task."""

    def __init__(self, path: str):
        import base64

        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})

    def encode(self, text: str):
        """Token ids as an array of unsigned 32-bit numbers; the special token's string is that token."""
        return self.encoding.encode_to_numpy(text, allowed_special="all")

    def raw(self, ids) -> bytes:
        return self.encoding.decode_bytes(ids.tolist())


def _lone_space(text: str, low: int, high: int, near: int) -> int | None:
    """The place closest to ``near`` of one space between two characters that are not white space."""
    best = None
    for step in (-1, 1):
        at = near
        while True:
            at = text.rfind(" ", low, at) if step < 0 else text.find(" ", at, high)
            if at < 0 or (best is not None and abs(at - near) >= abs(best - near)):
                break
            if at > 0 and at + 1 < len(text) and not text[at - 1].isspace() and not text[at + 1].isspace():
                best = at
                break
            at += step > 0
    return best


def halves(text: str, longest: int) -> list[tuple[str, bool]]:
    """Parts of a text in order, and whether each starts at a place that no token reaches over."""
    spans, out = [(0, len(text), True)], []
    while spans:
        low, high, clean = spans.pop()
        if high - low <= longest:
            out.append((text[low:high], clean))
            continue
        middle, reach = (low + high) // 2, (high - low) // 4
        at = _lone_space(text, middle - reach, middle + reach, middle)
        tidy = at is not None
        if at is None:
            at = middle
            special = text.rfind(SPECIAL, max(low, at - len(SPECIAL) + 1), at + len(SPECIAL) - 1)
            if special >= 0 and special < at < special + len(SPECIAL):
                at = special if special > low else special + len(SPECIAL)
        if not low < at < high:
            out.append((text[low:high], clean))
            continue
        spans.append((at, high, tidy))
        spans.append((low, at, clean))
    return out


def joined(left, right, codec: Codec, width: int = 16):
    """Tokens of two texts written one after the other, from the tokens of each."""
    import numpy as np

    while len(left) and len(right):
        a, b = min(width, len(left)), min(width, len(right))
        width *= 2
        try:
            window = codec.encode((codec.raw(left[len(left) - a :]) + codec.raw(right[:b])).decode("utf-8"))
        except UnicodeDecodeError:  # the window begins or ends inside a character
            if a == len(left) and b == len(right):
                raise
            width = max(a, b) + 1
            continue
        m = AGREEING
        agrees_left = a == len(left) or (len(window) >= m and a > m and np.array_equal(window[:m], left[len(left) - a :][:m]))
        agrees_right = b == len(right) or (len(window) >= m and b > m and np.array_equal(window[-m:], right[:b][-m:]))
        if agrees_left and agrees_right:
            return np.concatenate([left[: len(left) - a], window, right[b:]])
    return np.concatenate([left, right])


def tree(parts: list, clean: list[bool], codec: Codec):
    """Join the token lists of parts pairwise until one is left."""
    import numpy as np

    if not parts:
        return np.zeros(0, np.uint32)
    while len(parts) > 1:
        merged, begins = [], []
        for i in range(0, len(parts), 2):
            if i + 1 == len(parts):
                merged.append(parts[i])
            elif clean[i + 1]:
                merged.append(np.concatenate(parts[i : i + 2]))
            else:
                merged.append(joined(parts[i], parts[i + 1], codec))
            begins.append(clean[i])
        parts, clean = merged, begins
    return parts[0]


def _lists(arrays):
    import numpy as np
    import pyarrow as pa

    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def _encode(path: str, others: tuple[str, ...]):
    """Each text's ids; the other columns go along."""

    def run(batches):
        import pyarrow as pa

        codec = Codec(path)
        for batch in batches:
            for part in slices(batch):
                ids = [codec.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), _lists(ids)], [*others, "ids"])

    return run


def _split(longest: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                parts = halves(row.column("text")[0].as_py(), longest)
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row.column("row_id").to_pylist() * n, pa.int64()),
                        pa.array(row.column("doc_id").to_pylist() * n, row.column("doc_id").type),
                        pa.array(range(n), pa.int32()),
                        pa.array([c for _, c in parts], pa.bool_()),
                        pa.array([t for t, _ in parts], pa.string()),
                    ],
                    ["row_id", "doc_id", "part", "clean", "text"],
                )

    return run


def _assemble(path: str):
    held = {}  # the codec, once per task

    def run(group):
        import numpy as np
        import pyarrow as pa

        if not held:
            held["codec"] = Codec(path)
        group = group.sort_by("part")
        parts = [np.asarray(x.values, np.uint32) for x in group.column("ids")]
        ids = tree(parts, group.column("clean").to_pylist(), held["codec"])
        return pa.table({"doc_id": group.column("doc_id")[:1], "ids": _lists([ids])})

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", long_chars: int = LONG_CHARS) -> DataFrame:
    """``doc_id, ids``: token ids of each whole text, one row per input row.

    Null counts as empty and gives an empty list; rows that repeat are encoded each;
    other columns do not matter. A text's own ids must fit a row, as its text does. An
    empty table gives an empty result. Long texts are numbered as they are read, so ``docs``
    should be a table on disk or have a fixed order, lest a repeated task number them anew.
    """
    source = keyed(docs, id_col, text_col)
    id_type = source.schema["doc_id"].dataType.simpleString()
    longer = F.char_length("text") > long_chars
    short = source.filter(~longer).mapInArrow(_encode(path, ("doc_id",)), f"doc_id {id_type}, ids array<int>")
    kept = ("row_id", "doc_id", "part", "clean")
    spec = f"row_id long, doc_id {id_type}, part int, clean boolean"
    parts = (
        source.filter(longer)
        .withColumn("row_id", F.monotonically_increasing_id())
        .mapInArrow(_split(long_chars // 2), f"{spec}, text string")
        .repartition(F.col("row_id"), F.col("part"))
        .mapInArrow(_encode(path, kept), f"{spec}, ids array<int>")
    )
    long = parts.groupBy("row_id").applyInArrow(_assemble(path), f"doc_id {id_type}, ids array<int>")
    return short.unionByName(long)


def _decode(path: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        codec = Codec(path)
        for batch in batches:
            texts = [codec.raw(np.asarray(x.values)).decode("utf-8", "replace") for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return run


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """Add ``text`` to ``doc_id, ids``; bytes that are no UTF-8 become U+FFFD.

    A null or empty list is an empty text; null ids, rows that repeat and lists of any
    length are decoded each. Other columns are left out. An empty table gives an empty result.
    """
    ids = F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    schema = f"doc_id {tokens.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string"
    return tokens.select("doc_id", ids).mapInArrow(_decode(path), schema)


def digests(decoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what ``decode`` returns."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
