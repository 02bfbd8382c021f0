"""Substring deduplication by suffix automata of reference shards.

A window of ``window`` words is repeated if it also starts in a document with a smaller
id. Equal windows are brought together by their anchor, the least hash among the
short word runs inside a window, which does not depend on what surrounds the window.

1. Anchors of all documents are counted. A window whose anchor only one document has
   cannot be repeated; this leaves a small part of the text.
2. The rest is cut into segments, runs of windows with one anchor. Equal segments are
   folded into one reference with its least owner, where all segments of an anchor are
   brought together: one that meets no other needs no automaton.
3. References are sharded by anchor. Each shard's suffix automaton knows the least
   owner of every stretch of words; segments stream through it, and wherever the
   matching statistic reaches the window length the window's least owner is read off.
4. Owners go back to the occurrences of a segment, and documents drop the words of
   windows whose owner has a smaller id. Neighbouring windows make maximal spans.

An anchor whose different segments hold very many words (a passage with a different
neighbour in each document) has its segments cut into single windows, which fold
natively, so that no shard grows with the number of documents that share a passage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import HOT_ROWS, flat, join_keyed, kept, keyed, slices, thrifty, working, written
from tidegate.llm.words import Words, grams, owners
from tidegate.session import lookup

# Words in a run that may be an anchor.
ANCHOR_WORDS = 5
# Windows in a segment at most; only periodic text has longer runs of one anchor.
SEGMENT_WINDOWS = 64
# Words of references that an automaton task holds, and the most of one anchor; an
# automaton takes some 500 bytes a word.
SHARD_WORDS = 1 << 16
ANCHOR_WORDS_MOST = 1 << 17
# Occurrences of one anchor that a task brings together at most; those of an anchor of more
# are folded by segment first. There are few such anchors, as many at most as this goes into
# all occurrences.
ANCHOR_ROWS_MOST = 1 << 11
# Shared anchors are broadcast as bits, two of each anchor: 16 bits an anchor, 2**28 (32 MB)
# at most. Beyond this many anchors, of which one other in six passes, the segments that
# pass meet the anchors in a join too.
FILTER_ANCHORS = 1 << 26
FILTER_BITS_EACH = 16
FILTER_BITS_MOST = 28
# Least owner of null ids: above every id, so they own nothing.
LAST = (1 << 63) - 1


def _windows(words: Words, data, offsets, window: int):
    """Words and, per document, the anchor of each window: ``(starts, ends, first, place, anchor)``.

    ``place`` is the index of the window's first word among all words.
    """
    import numpy as np

    starts, ends, first = words.spans(data, offsets)
    runs = grams(words.hashes(data, starts, ends), ANCHOR_WORDS)
    width = window - ANCHOR_WORDS + 1
    least = runs
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:]) if len(least) > span else least[:0]
        span *= 2
    if span < width and len(least):
        rest = width - span
        least = np.minimum(least[:-rest], least[rest:]) if len(least) > rest else least[:0]
    end_of = np.repeat(first[1:], np.diff(first))[: len(least)]
    place = np.flatnonzero(np.arange(len(least)) + window <= end_of)
    return starts, ends, first, place, least[place].view(np.int64)


def _runs(place, anchor, doc, longest: int):
    """Begin and end (among windows) of each run of neighbouring windows with one anchor in one document."""
    import numpy as np

    if not len(place):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(place), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(place))
    if (end - begin).max() > longest:
        cut = [(a, min(a + longest, e)) for b, e in zip(begin.tolist(), end.tolist()) for a in range(b, e, longest)]
        begin, end = np.array(cut, np.int64).T
    return begin, end


def _anchors(window: int):
    """Anchor and document, once per document and run."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        words = Words()
        for batch in batches:
            for part in slices(batch):
                data, offsets = flat(part.column("text"))
                _, _, first, place, anchor = _windows(words, data, offsets, window)
                doc = owners(first)[place]
                begin, _ = _runs(place, anchor, doc, 1 << 60)
                pair = np.unique(np.stack([anchor[begin], doc[begin]], 1), axis=0) if len(begin) else np.zeros((0, 2), np.int64)
                order = part.column("order").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(order[pair[:, 1]])], ["anchor", "order"])

    return run


def _segments(window: int, shared, bits: int):
    """Segments of the documents whose anchor may be shared."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        words = Words()
        table = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for part in slices(batch):
                data, offsets = flat(part.column("text"))
                starts, ends, first, place, anchor = _windows(words, data, offsets, window)
                for shift in (0, FILTER_BITS_MOST):
                    bit = (anchor >> shift) & ((1 << bits) - 1)
                    keep = (table[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                    place, anchor = place[keep], anchor[keep]
                doc = owners(first)[place]
                begin, end = _runs(place, anchor, doc, SEGMENT_WINDOWS)
                low, high = place[begin], place[end - 1] + window - 1 if len(end) else place[:0]
                raw = data.tobytes() if len(begin) else b""
                texts = [b" ".join(raw[a:b].split()) for a, b in zip(starts[low].tolist(), ends[high].tolist())]
                of = doc[begin]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[begin]),
                        pa.array(texts, pa.binary()),
                        part.column("order").take(pa.array(of)),
                        part.column("text_key").take(pa.array(of)),
                        pa.array((low - first[of]).astype(np.int64)),
                    ],
                    ["anchor", "segment", "order", "text_key", "place"],
                )

    return run


class Automaton:
    """Suffix automaton of word sequences; each state keeps the least owner of its stretches."""

    def __init__(self):
        self.next, self.link, self.length, self.owner = [{}], [-1], [0], [LAST]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(LAST)
        return len(self.next) - 1

    def add(self, words: list, owner: int) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)
            if owner < self.owner[last]:
                self.owner[last] = owner

    def _extend(self, last: int, word) -> int:
        moves, link, length = self.next, self.link, self.length
        if word in moves[last]:
            old = moves[last][word]
            return old if length[old] == length[last] + 1 else self._clone(last, word, old)
        new = self._state(length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in moves[at]:
            moves[at][word] = new
            at = link[at]
        if at >= 0:
            old = moves[at][word]
            link[new] = old if length[old] == length[at] + 1 else self._clone(at, word, old)
        return new

    def _clone(self, at: int, word, old: int) -> int:
        moves, link = self.next, self.link
        twin = self._state(self.length[at] + 1, moves[old].copy(), link[old])
        link[old] = twin
        while at >= 0 and moves[at].get(word) == old:
            moves[at][word] = twin
            at = link[at]
        return twin

    def settle(self) -> None:
        """Least owners also count for all shorter endings."""
        owner, link = self.owner, self.link
        for state in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            if owner[state] < owner[link[state]]:
                owner[link[state]] = owner[state]

    def least_owners(self, words: list, window: int) -> list[int]:
        """Least owner of each window of ``words``; ``LAST`` where the matching statistic is shorter."""
        moves, link, length = self.next, self.link, self.length
        state = matched = 0
        out = []
        for i, word in enumerate(words):
            while state and word not in moves[state]:
                state = link[state]
                matched = length[state]
            if word in moves[state]:
                state = moves[state][word]
                matched += 1
            if i + 1 >= window:
                if matched < window:
                    out.append(LAST)
                    continue
                at = state
                while length[link[at]] >= window:
                    at = link[at]
                out.append(self.owner[at])
        return out


def _owners(window: int):
    """Per reference of a shard: the least owner of each of its windows."""

    def run(shard):
        from collections import defaultdict

        import pyarrow as pa

        by_anchor = defaultdict(list)
        rows = zip(*(shard.column(c).to_pylist() for c in ("anchor", "segment", "least", "several")))
        for anchor, segment, least, several in rows:
            by_anchor[anchor].append((segment, least, several))
        out = []
        for references in by_anchor.values():
            automaton = Automaton()
            split = [(segment, segment.split(b" "), least, several) for segment, least, several in references]
            for _, words, least, _ in split:
                automaton.add(words, least)
            automaton.settle()
            for segment, words, least, several in split:
                found = automaton.least_owners(words, window)
                if several or min(found) < least:
                    out.append((segment, found))
        return pa.table({"segment": pa.array([s for s, _ in out], pa.binary()), "least": pa.array([o for _, o in out], pa.list_(pa.int64()))})

    return run


def _prints():
    """128 bits that stand for a segment in joins."""
    return [F.xxhash64("segment").alias("print"), F.xxhash64(F.lit(7), F.col("segment")).alias("print_2")]


def _references(occurrences: DataFrame) -> DataFrame:
    """Different segments with their least owner, those left out that meet no other of their anchor and have one owner.

    ``met`` says that the anchor has others, ``crowded`` that they hold very many words;
    only a segment that is met keeps its text. Anchors, of which the driver could not hold
    all, are looked at where their occurrences are brought together; those of very many
    occurrences, which would each be one task's work, are folded first and then looked up.
    """
    hot = written(occurrences.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > ANCHOR_ROWS_MOST).select("anchor"), "hot-anchors")
    words = F.octet_length("segment") - F.octet_length(F.replace(F.col("segment").cast("string"), F.lit(" "), F.lit(""))) + 1

    def folded(rows):
        out = rows.groupBy("anchor", "segment").agg(
            F.min("order").alias("least"), (F.min("order") < F.max("order")).alias("several"), F.count(F.lit(1)).alias("n")
        )
        return out.withColumn("words", words.cast("long"))

    count, held = F.count(F.lit(1)), F.sum("words")
    by_anchor = Window.partitionBy("anchor")
    rows = occurrences
    found = []
    if not hot.isEmpty():
        rows = occurrences.join(lookup(hot), "anchor", "left_anti")
        many = written(folded(occurrences.join(lookup(hot), "anchor", "left_semi")), "hot-references")
        totals = written(many.groupBy("anchor").agg(count.alias("others"), held.alias("held")), "hot-totals")
        found.append(many.join(lookup(totals), "anchor"))
    found.append(folded(rows.repartition("anchor")).withColumns({"others": count.over(by_anchor), "held": held.over(by_anchor)}))
    met = F.col("others") > 1
    judged = reduce(DataFrame.unionByName, found).filter(met | F.col("several"))
    return written(
        judged.select(
            "anchor", F.when(met, F.col("segment")).alias("segment"), *_prints(), "least", "several", "n", "words",
            met.alias("met"), (met & (F.col("held") > ANCHOR_WORDS_MOST)).alias("crowded"),
        ),
        "references",
    )


def _single_windows(window: int):
    words = F.split(F.col("segment").cast("string"), " ")
    return F.transform(F.sequence(F.lit(1), F.size(words) - F.lit(window - 1)), lambda i: F.concat_ws(" ", F.slice(words, i, window)).cast("binary"))


def _folded_windows(references: DataFrame, window: int) -> DataFrame:
    """``print, print_2, least``: the least owner of each window of references, folded natively window by window."""
    alone = references.select(*_prints(), "least", F.posexplode(_single_windows(window)).alias("at", "window"))
    windows = [F.xxhash64("window").alias("window_print"), F.xxhash64(F.lit(7), F.col("window")).alias("window_print_2")]
    alone = written(alone.select("print", "print_2", "least", "at", *windows), "single-windows")
    keys = ["window_print", "window_print_2"]
    folded = written(alone.groupBy(*keys).agg(F.min("least").alias("least"), F.count(F.lit(1)).alias("n")), "folded-windows")
    found = join_keyed(alone.drop("least"), folded, keys, "n").groupBy("print", "print_2")
    # as many windows as a segment has
    found = found.agg(F.array_sort(F.collect_list(F.struct("at", "least"))).alias("windows"))
    return found.select("print", "print_2", F.col("windows")["least"].alias("least"))


def _bit_filter(shared: DataFrame, count: int):
    """The shared anchors as bits, two of each; bounded by ``FILTER_BITS_MOST``.

    Anchors are least hashes, so their leading bits are mostly zeros and tell little.
    """
    import numpy as np

    bits = min(max(15, (count * FILTER_BITS_EACH).bit_length()), FILTER_BITS_MOST)
    both = F.array(*(F.shiftright("anchor", shift).bitwiseAND((1 << bits) - 1) for shift in (0, FILTER_BITS_MOST)))
    rows = (
        shared.select(F.explode(both).alias("bit"))
        .groupBy(F.shiftright("bit", 15).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND((1 << 15) - 1)).alias("bits"))
    )
    table = np.zeros(1 << (bits - 3), np.uint8)
    for row in rows.toLocalIterator():
        table[row.bucket << 12 : (row.bucket + 1) << 12] = np.frombuffer(row.bits, np.uint8)
    return table.tobytes(), bits


def repeated_spans(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, spans``: for each row with repeated windows, the maximal word spans they cover.

    ``spans`` holds ``first`` and ``last`` word (from 0). ``text_key`` tells rows with
    one ``doc_id`` and different texts apart. A null ``doc_id`` counts as above all
    others; null texts have no words.
    """
    with working(docs.sparkSession):
        return kept(_spans(docs, window, id_col, text_col), "spans")


def _spans(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    source = _rows(docs, id_col, text_col)
    anchors = source.select("order", "text").mapInArrow(thrifty(_anchors(window)), "anchor long, order long")
    shared = written(
        anchors.groupBy("anchor").agg(F.min("order").alias("low"), F.max("order").alias("high")).filter("low < high").select("anchor"), "anchors"
    )
    count = shared.count()
    table, bits = _bit_filter(shared, count)
    held = spark.sparkContext.broadcast(table)
    found = source.select("order", "text_key", "text").mapInArrow(
        thrifty(_segments(window, held, bits)), "anchor long, segment binary, order long, text_key long, place long"
    )
    if count > FILTER_ANCHORS:
        found = found.join(shared, "anchor", "left_semi")
    occurrences = written(found, "segments")
    held.destroy()
    references = _references(occurrences)
    # a segment that meets no other of its anchor: its windows have its own least owner
    alone = references.filter("NOT met")
    owned = [alone.select("print", "print_2", F.array_repeat("least", F.col("words").cast("int") - (window - 1)).alias("least"))]
    crowded = references.filter("crowded")
    if not crowded.isEmpty():
        owned.append(_folded_windows(crowded, window))
    matched = references.filter("met AND NOT crowded")
    shards = -(-(matched.agg(F.sum("words")).first()[0] or 0) // SHARD_WORDS)
    if shards:
        matched = matched.select(F.pmod("anchor", F.lit(shards)).alias("shard"), "anchor", "segment", "least", "several")
        owned.append(matched.groupBy("shard").applyInArrow(_owners(window), "segment binary, least array<long>").select(*_prints(), "least"))
    owned = written(reduce(DataFrame.unionByName, owned), "owners")
    frequent = references.filter(F.col("n") >= HOT_ROWS).select("print", "print_2", "n")
    owned = owned.join(lookup(written(frequent, "frequent")), ["print", "print_2"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    hit = (
        join_keyed(occurrences.select(*_prints(), "order", "text_key", "place"), owned, ["print", "print_2"], "n")
        .withColumn("hits", F.expr("filter(transform(least, (o, i) -> if(o < `order`, i, -1)), i -> i >= 0)"))
        .filter(F.size("hits") > 0)
    )
    low, high = F.array_min("hits"), F.array_max("hits")
    solid = high - low + 1 == F.size("hits")
    ends = F.when(solid, F.array(F.struct(low.alias("a"), high.alias("b")))).otherwise(F.transform("hits", lambda i: F.struct(i.alias("a"), i.alias("b"))))
    spans = (
        hit.withColumn("end", F.explode(ends))
        .groupBy("order", "text_key")
        .agg(F.collect_set(F.struct((F.col("place") + F.col("end.a")).alias("first"), (F.col("place") + F.col("end.b")).alias("last"))).alias("windows"))
        .mapInArrow(_merged(window), "order long, text_key long, spans array<struct<first:long,last:long>>")
    )
    return spans


def _merged(window: int):
    """Runs of windows as maximal spans of words."""

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        for batch in batches:
            out = []
            for runs in batch.column("windows").to_pylist():
                spans: list[dict] = []
                for first, last in sorted((r["first"], r["last"] + window - 1) for r in runs):
                    if spans and first <= spans[-1]["last"] + 1:
                        spans[-1]["last"] = max(spans[-1]["last"], last)
                    else:
                        spans.append({"first": first, "last": last})
                out.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column("order"), batch.column("text_key"), pa.array(out, kind)], ["order", "text_key", "spans"])

    return run


def _removed(with_text: bool, others: tuple[str, ...]):
    """Word counts, the digest of the kept words, and the text without the removed spans."""

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        finder = Words()
        for batch in batches:
            counts, gone, digests, texts = [], [], [], []
            for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
                words = text.split()
                counts.append(len(words))
                if spans:
                    keep = np.ones(len(words), bool)
                    for span in spans:
                        keep[span["first"] : span["last"] + 1] = False
                    if with_text:
                        starts, _, _ = finder.spans(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
                        begins = [*starts.tolist(), len(text)]
                        at, kept = 0, []
                        for span in spans:
                            kept.append(text[at : begins[span["first"]]])
                            at = begins[span["last"] + 1]
                        text = b"".join([*kept, text[at:]])
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                gone.append(counts[-1] - len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                if with_text:
                    texts.append(text)
            arrays = [*(batch.column(c) for c in others), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
            names = [*others, "n_words", "n_removed", "kept_sha256"]
            if with_text:
                arrays, names = [*arrays, pa.array(texts, pa.binary()).cast(pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


# Bytes of spans that are broadcast; more are joined by shuffle.
BROADCAST_BYTES = 48 << 20


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for each row, with ``kept_text`` on demand.

    Every word is removed that a window covers whose words also start in a document
    with a smaller id. ``kept_sha256`` is of the kept words joined by one space;
    ``kept_text`` has them with the white space that follows each in the text, and is
    the text itself where nothing is removed. Null and empty texts have no words. Rows
    that repeat a ``doc_id`` are judged each, and not against one another. A null id
    counts as above all others. A very long text is worked on alone, and whole. An empty
    table gives an empty result. ``carry`` names further columns to return.
    """
    spans = repeated_spans(docs, window, id_col, text_col)
    size = spans.agg(F.sum(F.size("spans") * 16 + 64)).first()[0] or 0
    rows = _rows(docs, id_col, text_col, **{f"carry_{i}": F.col(c) for i, c in enumerate(carry)})
    joined = rows.join(F.broadcast(spans) if size <= BROADCAST_BYTES else spans, ["order", "text_key"], "left").drop("order", "text_key")
    others = tuple(c for c in joined.columns if c not in ("text", "spans"))
    made = T.StructType.fromDDL("n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)
    out = joined.mapInArrow(thrifty(_removed(with_text, others)), T.StructType([*(joined.schema[c] for c in others), *made]))
    return out.withColumnsRenamed({f"carry_{i}": c for i, c in enumerate(carry)})


def _rows(docs: DataFrame, id_col: str, text_col: str, **extra) -> DataFrame:
    rows = keyed(docs, id_col, text_col, **extra)
    return rows.withColumn("order", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn("text_key", F.xxhash64("text"))
