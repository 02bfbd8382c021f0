"""Near-duplicate classes by ProbMinHash, banding and verification.

A text is the set of its five-word shingles. A shingle's weight grows slowly with how
often it occurs, so that a line repeated a thousand times does not drown the rest. Each
shingle is a Poisson process with its weight as rate: its arrivals fall on
the registers one after another, in an order and at gaps drawn from the shingle's hash
alone. A register keeps the shingle that arrives first. A text's shingles stop as soon as
their next arrival is later than every register's, so most make a few steps only. Two
texts agree in a register with a chance equal to their probability Jaccard similarity.

Links are judged by sets of shingles, so a text with repeated shingles is also entered
under a second signature, in which every shingle weighs 1. In texts without repeats the
two are the same. Of any two texts the even signatures meet in a bucket as often as the
Jaccard similarity of their sets says, whatever repeats in them; the weighted ones bring
further candidates, texts that repeat the same lines.

Registers are banded; texts that share a band are compared. The work on a bucket is
bounded: comparisons first go by registers, and texts without a promising partner leave.
Promising pairs are verified on their shingles, but only while nothing else has connected
them, so a bucket returns fewer links than it has members. Buckets whose members are in one class already
drop out between waves of bands. A bucket that is too large for a task is divided by
further bands; if several classes are left in it, they are compared in pairs of blocks.

Texts of equal words are folded first, so thousands of copies are one member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import flat, join_keyed, kept, keyed, slices, thrifty, working, written
from tidegate.llm.words import BASE, Words, _mix, grams, owners
from tidegate.session import lookup

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# Doublings of a shingle's occurrences that double its weight.
DOUBLINGS = 16
# 32 bands of 6: two texts at the threshold share no band with a chance of 6 in 100,000.
BANDS, BAND_ROWS = 32, 6
# A prime, so that steps by any stride visit all registers; those beyond the bands are not used.
REGISTERS = 193
# Pairs whose even registers agree less than this are not verified: 4.8 standard deviations
# (0.029 with 192 registers) below the threshold.
PROMISING = 0.66
WAVES = ((0, 4), (4, BANDS))
BUCKET_MEMBERS = 2048
BIN_MEMBERS = 4096
# Candidates are found by broadcast up to this many, by shuffle beyond.
BROADCAST_ROWS = 1_000_000
LAST = (1 << 63) - 1
# What is known of a member of a bucket; ``band`` is -1 where the bucket is not a whole band's.
GROUP = ["bucket", "band", "block", "node", "label"]


def shingles(words: Words, texts):
    """Distinct shingles of flat texts: ``(owner, hash, weight)``, sorted by owner and hash."""
    import numpy as np

    data, offsets = flat(texts)
    starts, ends, first = words.spans(data, offsets)
    gram = grams(words.hashes(data, starts, ends), SHINGLE_WORDS)
    owner = owners(first)[: len(gram)]
    whole = np.arange(len(gram)) + SHINGLE_WORDS <= np.repeat(first[1:], np.diff(first))[: len(gram)]
    owner, gram = owner[whole], gram[whole]
    order = np.lexsort((gram, owner))
    owner, gram = owner[order], gram[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    return owner[begin], gram[begin], 1 + np.log2(np.diff(np.append(begin, len(gram)))) / DOUBLINGS


def registers(owner, gram, weight, texts: int):
    """The first shingle to arrive at each register of each text, 0 for a text without any."""
    import numpy as np

    time = np.full(texts * REGISTERS, np.inf)
    winner = np.zeros(texts * REGISTERS, np.uint64)
    order = _mix(gram ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    place = (order % np.uint64(REGISTERS)).astype(np.int64)
    stride = (1 + (order >> np.uint64(20)) % np.uint64(REGISTERS - 1)).astype(np.int64)
    clock = np.zeros(len(gram))
    base, rate = owner * REGISTERS, weight / REGISTERS
    for step in range(REGISTERS):
        bits = _mix(gram + np.uint64((step + 1) * BASE % 2**64))
        gap = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        clock += gap / (rate * (REGISTERS - step))
        at = base + place
        np.minimum.at(time, at, clock)
        first = time[at] == clock
        winner[at[first]] = gram[first]
        latest = time.reshape(texts, REGISTERS).max(axis=1)
        on = np.flatnonzero(clock < latest[owner])
        if not len(on):
            break
        place = (place[on] + stride[on]) % REGISTERS
        gram, owner, clock, stride, base, rate = (x[on] for x in (gram, owner, clock, stride, base, rate))
    return winner.reshape(texts, REGISTERS)[:, : BANDS * BAND_ROWS]


def _band_keys(found):
    import numpy as np

    factors = np.uint64(BASE) ** np.arange(1, 2 * BAND_ROWS, 2, dtype=np.uint64)
    return _mix((found.reshape(len(found), BANDS, BAND_ROWS) * factors).sum(axis=2, dtype=np.uint64)).view(np.int64)


def _signatures(batches):
    """Per row: 128 bits of its word sequence and its band keys, even ones and then weighted ones that differ."""
    import numpy as np
    import pyarrow as pa

    words = Words()
    for batch in batches:
        for part in slices(batch):
            texts = part.column("text")
            owner, gram, weight = shingles(words, texts)
            n = part.num_rows
            keys = _band_keys(registers(owner, gram, np.ones(len(gram)), n))
            uneven = np.bincount(owner, weights=weight > 1, minlength=n) > 0
            also = uneven[owner]
            again = np.cumsum(uneven) - 1
            weighted = _band_keys(registers(again[owner[also]], gram[also], weight[also], int(uneven.sum())))
            has = np.bincount(owner, minlength=n) > 0
            ends = np.cumsum(np.append(0, has * BANDS + uneven * BANDS))
            every = np.empty(ends[-1], np.int64)
            at = ends[:-1][has][:, None] + np.arange(BANDS)
            every[at] = keys[has]
            at = ends[:-1][uneven][:, None] + BANDS + np.arange(BANDS)
            every[at] = weighted
            none = np.zeros(len(every), bool)
            none[at] = weighted == keys[uneven]
            ends = ends.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row_id"),
                    part.column("doc_id"),
                    part.column("key"),
                    *_prints(texts),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(every, mask=none)),
                ],
                ["row_id", "doc_id", "key", "print", "print_2", "keys"],
            )


def _prints(texts):
    """128 bits of each text's word sequence, as two signed numbers."""
    import numpy as np
    import pyarrow as pa
    import xxhash

    whole = [xxhash.xxh3_128_intdigest(b" ".join(t.split())) for t in texts.cast(pa.binary()).to_pylist()]
    return [pa.array(np.array([p >> shift & (2**64 - 1) for p in whole], np.uint64).view(np.int64)) for shift in (0, 64)]


def _packed(batches):
    """16 bits of each even register, and the shingles as sorted 64-bit hashes."""
    import numpy as np
    import pyarrow as pa

    words = Words()
    for batch in batches:
        for part in slices(batch):
            owner, gram, _ = shingles(words, part.column("text"))
            found = registers(owner, gram, np.ones(len(gram)), part.num_rows).astype("<u2")
            ends = np.searchsorted(owner, np.arange(part.num_rows + 1)).tolist()
            spans = list(zip(ends, ends[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    *_prints(part.column("text")),
                    pa.array([row.tobytes() for row in found], pa.binary()),
                    pa.array([gram[a:b].astype("<u8").tobytes() for a, b in spans], pa.binary()),
                ],
                ["print", "print_2", "registers", "shingles"],
            )


def similarity(left, right) -> float:
    """Jaccard similarity of two sets of sorted hashes."""
    import numpy as np

    common = len(np.intersect1d(left, right, assume_unique=True))
    return common / max(1, len(left) + len(right) - common)


def _buckets(rows):
    """The buckets of a bin, each sorted by node."""
    import numpy as np

    rows = rows.sort_by([("bucket", "ascending"), ("node", "ascending")])
    bucket = rows.column("bucket").to_numpy()
    cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
    for a, b in zip(cuts, cuts[1:]):
        if b - a > 1:
            yield rows.slice(a, b - a)


def _promising_pairs(bucket, wave: tuple[int, int]):
    """``(agreement, i, j)`` of the members of two classes whose registers agree enough.

    Members that share several bands of a wave meet in the first of them only.
    """
    import numpy as np

    label, side = bucket.column("label").to_numpy(), bucket.column("block").to_numpy()
    band = bucket.column("band")[0].as_py()
    table = np.stack([np.frombuffer(r, "<u2") for r in bucket.column("registers").to_pylist()])
    two_sided = side.min() != side.max()
    for i in range(len(label) - 1):
        fine = label[i + 1 :] != label[i]
        if two_sided:  # pairs inside a block are compared in the block's own group
            fine &= side[i + 1 :] != side[i]
        j = np.flatnonzero(fine) + i + 1
        same = table[j] == table[i]
        agreed = same.mean(axis=1)
        fine = agreed >= PROMISING
        if band > wave[0]:
            fine &= ~same[:, wave[0] * BAND_ROWS : band * BAND_ROWS].reshape(len(j), band - wave[0], BAND_ROWS).all(axis=2).any(axis=1)
        yield agreed[fine], i, j[fine]


def _promising(wave: tuple[int, int]):
    """Members with a promising partner of another class."""

    def run(rows):
        import numpy as np
        import pyarrow as pa

        held = [rows.select(GROUP).slice(0, 0)]
        for bucket in _buckets(rows):
            some = np.zeros(bucket.num_rows, bool)
            for _, i, j in _promising_pairs(bucket, wave):
                some[j] = True
                some[i] |= len(j) > 0
            held.append(bucket.select(GROUP).filter(pa.array(some)))
        return pa.concat_tables(held)

    return run


def _connected(threshold: float, wave: tuple[int, int]):
    """Links of each bucket that connect what is not connected yet."""

    def run(rows):
        import numpy as np
        import pyarrow as pa

        links = []
        for bucket in _buckets(rows):
            node, raw = bucket.column("node").to_numpy(), bucket.column("shingles")
            held: dict = {}

            def of(i):
                if i not in held:
                    held[i] = np.frombuffer(raw[i].as_py(), "<u8")
                return held[i]

            classes = np.unique(bucket.column("label").to_numpy(), return_inverse=True)[1].tolist()
            above = list(range(len(node)))

            def root(c):
                while above[c] != c:
                    above[c] = above[above[c]]
                    c = above[c]
                return c

            pairs = [np.stack([agreed, np.full(len(j), i), j], 1) for agreed, i, j in _promising_pairs(bucket, wave)]
            pairs = np.concatenate([np.zeros((0, 3)), *pairs])
            for i, j in pairs[np.argsort(-pairs[:, 0], kind="stable"), 1:].astype(int).tolist():
                a, b = root(classes[i]), root(classes[j])
                if a != b and similarity(of(i), of(j)) >= threshold:
                    above[max(a, b)] = min(a, b)
                    links.append((node[i], node[j]))
        ends = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": ends[:, 0], "b": ends[:, 1]})

    return run


def _binned(members: DataFrame, rows: int):
    """Whole buckets, some ``BIN_MEMBERS`` members to a task's call."""
    bins = -(-rows // BIN_MEMBERS) or 1
    return members.withColumn("bin", F.pmod(F.xxhash64("bucket"), F.lit(bins))).groupBy("bin")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for each node of ``links`` (``a``, ``b``): the least node it is connected with.

    Every node takes the least label around it, then its label's label, until nothing
    changes; long chains shorten by half each round.
    """
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        around = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = written(labels.join(around, labels.node == around.a).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "labels")
        there = lower.select(F.col("node").alias("at"), F.col("label").alias("further"))
        jumped = lower.join(there, F.col("label") == F.col("at"), "left").select("node", "old", F.coalesce("further", "label").alias("label"))
        jumped = written(jumped, "labels")
        if jumped.filter("label < old").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")


def _mixed_buckets(members: DataFrame) -> DataFrame:
    """Members of buckets that hold several classes, with the bucket's size."""
    sizes = members.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"))
    mixed = sizes.filter("low < high").select("bucket", "size")
    return written(members.join(lookup(written(mixed, "mixed")), "bucket"), "members")


def _groups(members: DataFrame, bands: DataFrame) -> DataFrame:
    """``bucket, band, block, node, label``: the groups of a wave.

    Buckets too large for a task are divided by each further band their members are in.
    That finds most of their links; the rest is left to ``_block_pairs``.
    """
    whole = F.lit(0).cast("long").alias("block")
    fits, crowds = F.col("size") <= BUCKET_MEMBERS, F.col("size") > BUCKET_MEMBERS
    mixed = _mixed_buckets(members)
    ready = mixed.filter(fits).select("bucket", "band", whole, "node", "label")
    crowded = mixed.filter(crowds)
    if crowded.isEmpty():
        return ready
    other = bands.withColumnRenamed("band", "by")
    finer = crowded.join(other, "node").filter("by <> band").select(F.xxhash64("bucket", "by", "band_key").alias("bucket"), "node", "label")
    return ready.unionByName(_mixed_buckets(finer).filter(fits).select("bucket", F.lit(-1).alias("band"), whole, "node", "label"))


def _block_pairs(members: DataFrame) -> DataFrame | None:
    """Groups that compare all classes of the buckets too large for a task, or None if there are no such.

    Members are dealt to blocks, those of a large class to blocks of its own. Two blocks
    of one class need no comparison, so a huge class meets the few members outside it
    and not itself.
    """
    crowded = written(_mixed_buckets(members).filter(F.col("size") > BUCKET_MEMBERS), "crowded")
    if crowded.isEmpty():
        return None
    half = BUCKET_MEMBERS // 2
    classes = crowded.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    owner = F.when(F.col("n") > half, F.col("label"))
    shares = classes.withColumn("owner", owner)
    totals = shares.groupBy("bucket", "owner").agg(F.sum("n").alias("total"))
    sized = written(shares.alias("s").join(totals.alias("t"), (F.col("s.bucket") == F.col("t.bucket")) & F.col("s.owner").eqNullSafe(F.col("t.owner"))).select("s.bucket", "s.label", "s.owner", "t.total"), "shares")
    number = F.pmod(F.xxhash64("node"), F.ceil(F.col("total") / half))
    dealt = crowded.join(sized, ["bucket", "label"]).withColumn("block", F.xxhash64("owner", number))
    dealt = written(dealt.select("bucket", "block", "owner", "node", "label"), "blocks")
    blocks = dealt.select("bucket", "block", "owner").distinct()
    others = blocks.select("bucket", F.col("block").alias("other"), F.col("owner").alias("other_owner"))
    met = blocks.join(others, "bucket").filter("block <= other AND (owner IS NULL OR other_owner IS NULL OR owner <> other_owner)")
    pair = F.xxhash64("bucket", "block", "other").alias("pair")
    sides = met.select("bucket", pair, F.explode(F.array_distinct(F.array("block", "other"))).alias("block"))
    out = dealt.join(sides, ["bucket", "block"])
    return out.select(F.col("pair").alias("bucket"), F.lit(-1).alias("band"), "block", "node", "label")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None) -> DataFrame:
    """``doc_id, class_id, copy_of, class_size, kept, key`` for each row.

    Texts are linked if the Jaccard similarity of their five-word shingles is at least
    ``threshold``; a class is what links connect, and ``class_id``
    its smallest ``doc_id``. Texts of equal words are one member; ``copy_of`` is the
    smallest ``doc_id`` among them. Exactly one row of a class is kept, the one with the
    smallest ``doc_id``, null ids last, and one of those that repeat it. Texts under five
    words have no shingles and are linked to equal ones only; texts without words (null
    and empty too) equal each other. ``key`` is any 64-bit column to return with its row.
    An empty table gives an empty result.
    """
    with working(docs.sparkSession):
        return kept(_classes(docs, threshold, id_col, text_col, F.lit(0).cast("long") if key is None else key), "near-classes")


def _classes(docs: DataFrame, threshold: float, id_col: str, text_col: str, key: Column) -> DataFrame:
    source = keyed(docs, id_col, text_col, key=key, row_id=F.monotonically_increasing_id())
    id_type = source.schema["doc_id"].dataType.simpleString()
    spec = f"row_id long, doc_id {id_type}, key long, print long, print_2 long, keys array<long>"
    signed = written(source.mapInArrow(thrifty(_signatures), spec), "signatures").withColumn("order", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)))
    first = F.min(F.struct("order", "row_id", "doc_id", "keys"))
    folded = signed.groupBy("print", "print_2").agg(first.alias("first"), F.count(F.lit(1)).alias("copies"))
    folded = written(
        folded.select(
            "print", "print_2", "copies", F.col("first.row_id").alias("node"), F.col("first.order").alias("order"),
            F.col("first.doc_id").alias("copy_of"), F.col("first.keys").alias("keys"),
        ),
        "folded",
    )
    bands = folded.select("node", F.posexplode("keys").alias("band", "band_key")).filter("band_key IS NOT NULL")
    bands = bands.withColumn("band", F.col("band") % BANDS)
    shared = bands.groupBy("band", "band_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written(shared, "buckets")
    bands = written(bands.join(lookup(shared.drop("n")), ["band", "band_key"]), "bands")
    candidates = written(bands.select("node").distinct(), "candidates")
    wanted = written(folded.join(candidates, "node", "left_semi").select("node", "print", "print_2", "copy_of"), "wanted")
    ids = wanted.select(F.col("copy_of").alias("wanted_id")).distinct()
    if candidates.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    texts = source.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    packed = texts.mapInArrow(thrifty(_packed), "print long, print_2 long, registers binary, shingles binary")
    packed = packed.dropDuplicates(["print", "print_2"]).join(wanted, ["print", "print_2"])
    payload = written(packed.select("node", "registers", "shingles"), "payload")
    links, labels = None, None

    def joined(groups, wave):
        groups = written(groups, "groups")
        marked = _binned(payload.select("node", "registers").join(lookup(groups), "node"), groups.count())
        groups = written(marked.applyInArrow(_promising(wave), "bucket long, band int, block long, node long, label long"), "promising")
        compared = _binned(payload.join(lookup(groups), "node"), groups.count())
        found = written(compared.applyInArrow(_connected(threshold, wave), "a long, b long").distinct(), "links")
        return found if links is None else links.unionByName(found)

    def labelled(rows):
        rows = rows.select(F.xxhash64("band", "band_key").alias("bucket"), "band", "node")
        if labels is None:
            return rows.withColumn("label", F.col("node"))
        return rows.join(lookup(labels), "node", "left").withColumn("label", F.coalesce("label", "node"))

    for low, high in WAVES:
        links = joined(_groups(labelled(bands.filter((F.col("band") >= low) & (F.col("band") < high))), bands), (low, high))
        labels = components(links)
    large = shared.filter(F.col("n") > BUCKET_MEMBERS)
    if not large.isEmpty():
        rest = _block_pairs(labelled(bands.join(lookup(large.drop("n")), ["band", "band_key"])))
        if rest is not None:
            links = joined(rest, (0, 0))
            labels = components(links)
    members = folded.select("node", "print", "print_2", "copies", "order", "copy_of").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    members = written(members, "class-members")
    classes = members.groupBy("label").agg(
        F.min(F.struct("order", "node", "copy_of")).alias("first"), F.sum("copies").alias("class_size"), F.count(F.lit(1)).alias("members")
    )
    of = join_keyed(members, written(classes, "classes"), ["label"], "members").select(
        "print", "print_2", "copies", "copy_of", "class_size", F.col("first.copy_of").alias("class_id"), F.col("first.node").alias("keep")
    )
    joined = join_keyed(signed.select("row_id", "doc_id", "key", "print", "print_2"), written(of, "class-of"), ["print", "print_2"], "copies")
    return joined.select("doc_id", "class_id", "copy_of", "class_size", (F.col("row_id") == F.col("keep")).alias("kept"), "key")
