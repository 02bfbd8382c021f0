"""Language of texts and of the spans inside them.

1. A text is cut into words, runs of letters of one script. The script of a word narrows
   the languages that it may be in to those that were learned with that script.
2. Each language left gives the word a score: the logarithm of how likely its character
   n-grams and the word as a whole are in that language, against the mean of all
   languages. A word of a script that no language has, scores nothing.
3. Viterbi finds the labels of all words of a text whose scores, less a penalty for each
   change of language, add up to the most. Neighbours with one label are a span.

The language of most letters is that of the text.

What is learned are counts of n-grams per language, taken by tasks from a bounded sample
of rows of each language and added up by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import flat, keyed, slices, thrifty, working, written
from tidegate.llm.labelled import fold
from tidegate.llm.words import BASE, Words, _mix, byte_values

# First and last character of the blocks that hold a script's letters.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x531, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
NO_LETTERS = "und"

# What is learned from: so many rows of a language, the least by a hash of their id, as
# long as their texts hold so many bytes; and the languages, the most frequent.
LANGUAGE_ROWS, LANGUAGE_BYTES, MOST_LANGUAGES = 2000, 1 << 24, 64
# A language is learned with a script that this share of its letters is in.
LEAST_SHARE = 0.02
# Characters, in bytes, of an n-gram; 0 is the word as a whole. Each has a table of 2 ** BITS entries.
SIZES, BITS = (2, 3, 4, 0), 16
# Added to all counts; the most that a word counts for or against a language; a change of language.
SMOOTH, MOST, SWITCH = 0.5, 8.0, 10.0


def _script_table():
    """Starts of ranges of characters, and the script (from 1; 0 is none) from each start on."""
    import numpy as np

    edges = sorted((low, high, i) for i, blocks in enumerate(SCRIPTS.values(), 1) for low, high in blocks)
    starts, kinds = [0], [0]
    for low, high, i in edges:
        starts += [low, high + 1]
        kinds += [i, 0]
    return np.array(starts), np.array(kinds, np.int8)


class Letters:
    """Finds words, runs of letters of one script, in flat UTF-8. Keeps its tables, so make one per task."""

    def __init__(self):
        self.starts, self.kinds = _script_table()
        self.letter: dict[int, int] = {}  # scripts of characters looked up so far
        self.others = len(SCRIPTS) + 1  # letters outside the scripts listed

    def _script(self, character: int) -> int:
        import unicodedata

        import numpy as np

        if unicodedata.category(chr(character))[0] not in "LM":
            return 0
        kind = int(self.kinds[np.searchsorted(self.starts, character, side="right") - 1])
        return kind or self.others

    def scripts(self, characters):
        """Script of each character, 0 where it is no letter."""
        import numpy as np

        different, where = np.unique(characters, return_inverse=True)
        found = [self.letter.get(c) for c in different.tolist()]
        for i, c in enumerate(different.tolist()):
            if found[i] is None:
                found[i] = self.letter[c] = self._script(c)
        return np.array(found, np.int8)[where] if len(found) else np.zeros(0, np.int8)

    def spans(self, data, offsets):
        """``(starts, ends, first, script)``: places of the words in ``data``; word ``first[d]`` is text d's first."""
        import numpy as np

        low, high = int(offsets[0]), int(offsets[-1])
        own = data[low:high]
        lead = np.flatnonzero((own & 0xC0) != 0x80)
        byte = own[lead]
        character = byte.astype(np.int32)
        for least, most, bits, more in ((0xC0, 0xDF, 0x1F, 1), (0xE0, 0xEF, 0x0F, 2), (0xF0, 0xF7, 0x07, 3)):
            long = np.flatnonzero((byte >= least) & (byte <= most))
            if len(long):
                value = (byte[long] & bits).astype(np.int32)
                for k in range(1, more + 1):
                    value = value << 6 | own[lead[long] + k] & 0x3F
                character[long] = value
        script = np.zeros(len(lead), np.int8)
        plain = character < 0x80
        script[plain] = (((byte[plain] | 0x20) >= 97) & ((byte[plain] | 0x20) <= 122)).astype(np.int8)
        script[~plain] = self.scripts(character[~plain])
        begins = np.zeros(len(lead) + 1, bool)
        begins[0] = True
        begins[1:-1] = script[1:] != script[:-1]
        begins[np.searchsorted(lead, offsets[1:-1] - low)] = True
        begins[-1] = True
        cut = np.flatnonzero(begins)
        edge = np.append(lead, high - low)
        if not len(lead):
            return edge[:0], edge[:0], np.zeros(len(offsets), np.int64), script
        starts, ends, kind = edge[cut[:-1]], edge[cut[1:]], script[cut[:-1]]
        word = kind > 0
        starts, ends = starts[word] + low, ends[word] + low
        return starts, ends, np.searchsorted(starts, offsets), kind[word]


class Grams:
    """Hashed n-grams of words, their edges included, and the words as a whole."""

    def __init__(self):
        import numpy as np

        self.words, self.values = Words(), byte_values()
        self.powers = np.array([pow(BASE, 2 * k + 1, 2**64) for k in range(8)], np.uint64)

    def __call__(self, data, starts, ends):
        """For each of ``SIZES``: the table entries of all words' n-grams, and where each word's begin."""
        import numpy as np

        shift = np.uint64(64 - BITS)
        if not len(starts):
            return [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in SIZES]
        # every word between two edges, one after another
        sizes = ends - starts + 2
        at = np.cumsum(sizes) - sizes
        inside = np.arange(sizes.sum()) - np.repeat(at, sizes)
        value = np.full(len(inside), np.uint64(BASE))
        letter = (inside > 0) & (inside < np.repeat(sizes, sizes) - 1)
        value[letter] = self.values[data[(np.repeat(starts, sizes) + inside - 1)[letter]]]
        out = []
        for size in SIZES:
            if not size:
                weight = _mix(inside.astype(np.uint64) * np.uint64(BASE) + np.uint64(7)) | np.uint64(1)
                whole = _mix(np.add.reduceat(value * weight, at))
                out.append(((whole >> shift).astype(np.int64), np.arange(len(starts))))
                continue
            count = np.maximum(sizes - size + 1, 1)  # a word shorter than the n-gram is one
            begin = np.cumsum(count) - count
            first = np.repeat(at, count) + np.arange(count.sum()) - np.repeat(begin, count)
            last = np.repeat(at + sizes, count)
            gram = np.zeros(len(first), np.uint64)
            for k in range(size):
                gram += np.where(first + k < last, value[np.minimum(first + k, len(value) - 1)], np.uint64(0)) * self.powers[k]
            out.append(((_mix(gram) >> shift).astype(np.int64), begin))
        return out


def lowered(texts):
    """Texts without case, flat."""
    import pyarrow as pa
    import pyarrow.compute as pc

    kind = pa.large_string() if pa.types.is_large_string(texts.type) else pa.string()
    return flat(pc.utf8_lower(texts.cast(kind)))


def _counts(batches):
    """Counts of n-grams, and of letters per script, by language."""
    import numpy as np
    import pyarrow as pa

    letters, grams = Letters(), Grams()
    for batch in batches:
        for part in slices(batch):
            data, offsets = lowered(part.column("text"))
            starts, ends, first, script = letters.spans(data, offsets)
            of = np.repeat(part.column("language").to_numpy().astype(np.int64), np.diff(first))
            # letters of each script, and each different word of a language with how often it occurs
            key, where = np.unique((of * 8 + 7) << BITS | script, return_inverse=True)
            keys, counts = [key], [np.bincount(where, weights=ends - starts, minlength=len(key))]
            mark = grams.words.hashes(data, starts, ends) * np.uint64(BASE) + of.astype(np.uint64)
            _, once, often = np.unique(mark, return_index=True, return_counts=True)
            for k, (entry, begin) in enumerate(grams(data, starts[once], ends[once])):
                sizes = np.diff(np.append(begin, len(entry)))
                key, where = np.unique((np.repeat(of[once], sizes) * 8 + k) << BITS | entry, return_inverse=True)
                keys.append(key)
                counts.append(np.bincount(where, weights=np.repeat(often, sizes), minlength=len(key)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(counts).astype(np.int64))], ["key", "n"])


class Model:
    """Languages by name, their scripts, and per n-gram size the scores of table entries."""

    def __init__(self, languages: list[str], scripts, tables):
        self.languages, self.scripts, self.tables = languages, scripts, tables

    @classmethod
    def of_counts(cls, languages: list[str], key, n):
        import numpy as np

        language, kind, entry = key >> BITS + 3, key >> BITS & 7, key & (1 << BITS) - 1
        tables = []
        for k in range(len(SIZES)):
            own = kind == k
            count = np.full((1 << BITS, len(languages)), SMOOTH, np.float32)
            count[entry[own], language[own]] += n[own]
            score = np.log(count / count.sum(axis=0))
            tables.append((score - score.mean(axis=1, keepdims=True)).astype(np.float32))
        own = kind == 7
        used = np.zeros((len(SCRIPTS) + 2, len(languages)))
        used[entry[own], language[own]] = n[own]
        return cls(languages, used >= LEAST_SHARE * np.maximum(used.sum(axis=0), 1), tables)

    def scores(self, data, starts, ends, script, grams: Grams):
        """Score of each word in each language; minus infinity where its script rules the language out."""
        import numpy as np

        if not len(starts):
            return np.zeros((0, len(self.languages)))
        # words that occur again have the scores of their first occurrence
        _, once, again = np.unique(grams.words.hashes(data, starts, ends), return_index=True, return_inverse=True)
        starts, ends, script = starts[once], ends[once], script[once]
        out = np.zeros((len(starts), len(self.languages)))
        for size, table, (entry, begin) in zip(SIZES, self.tables, grams(data, starts, ends)):
            total = np.add.reduceat(table[entry], begin, axis=0) if size else table[entry]
            # n-grams overlap, so each size counts as much as its n-grams would side by side
            out += total / (size or 1)
        out -= out.max(axis=1, keepdims=True)
        out = np.maximum(out, -MOST)
        able = self.scripts[script]
        out[~able.any(axis=1)] = 0.0
        out[~able & able.any(axis=1, keepdims=True)] = -np.inf
        return out[again]


def labels(scores, first, switch: float = SWITCH):
    """The languages of the words of each text that add up to the most, by Viterbi over all texts at once.

    Ties go to staying, then to the earlier language. Word ``first[d]`` is text d's first.
    """
    import numpy as np

    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    sizes, begin = sizes[order], first[:-1][order]
    came = np.zeros(scores.shape, np.int8 if scores.shape[1] < 128 else np.int16)
    best = np.zeros((len(sizes), scores.shape[1]))
    rows = np.arange(len(sizes))
    still = np.searchsorted(-sizes, -np.arange(sizes.max(initial=0)), side="left")  # texts with a word at each place
    for place, n in enumerate(still.tolist()):
        at = begin[:n] + place
        if place:
            now = best[:n]
            top = now.argmax(axis=1)
            moved = now[rows[:n], top][:, None] - switch
            stay = now >= moved
            came[at] = np.where(stay, np.arange(scores.shape[1]), top[:, None])
            best[:n] = np.where(stay, now, moved) + scores[at]
        else:
            best[:n] = scores[at]
    out = np.zeros(len(scores), np.int64)
    state = best.argmax(axis=1) if len(best) else np.zeros(0, np.int64)
    for place in range(len(still) - 1, -1, -1):
        n = still[place]
        at = begin[:n] + place
        out[at] = state[:n]
        state[:n] = came[at, state[:n]]
    return out


def _labelled(model: Model, switch: float, detail: bool, others: list[str]):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        letters, grams, size = Letters(), Grams(), len(model.languages)
        names = pa.array([*model.languages, NO_LETTERS], pa.string())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        for batch in batches:
            for part in slices(batch):
                data, offsets = lowered(part.column("text"))
                starts, ends, first, script = letters.spans(data, offsets)
                n, sizes = part.num_rows, np.diff(first)
                chosen, score = np.full(n, size), np.zeros(n)
                label = np.zeros(len(starts), np.int64)
                if size and len(starts):
                    label = labels(model.scores(data, starts, ends, script, grams), first, switch)
                    owner = np.repeat(np.arange(n), sizes)
                    share = np.bincount(owner * size + label, weights=ends - starts, minlength=n * size).reshape(n, size)
                    some = sizes > 0
                    chosen[some] = share[some].argmax(axis=1)
                    score[some] = share[some].max(axis=1) / share[some].sum(axis=1)
                arrays = [*(part.column(c) for c in others), names.take(pa.array(chosen)), pa.array(score)]
                if detail:
                    arrays.append(pa.array(_spans(data, offsets, starts, ends, first, label, model.languages), kind))
                yield pa.RecordBatch.from_arrays(arrays, [*others, "lang_pred", "score", *(["spans"] if detail else [])])

    return run


def _spans(data, offsets, starts, ends, first, label, languages):
    """Neighbouring words of one label, as places among the characters of each text."""
    import numpy as np

    low = int(offsets[0])
    character = np.concatenate([[0], np.cumsum((data[low : int(offsets[-1])] & 0xC0) != 0x80)])
    out = []
    for d in range(len(first) - 1):
        a, b = int(first[d]), int(first[d + 1])
        spans: list[dict] = []
        if languages:
            zero = character[offsets[d] - low]
            for s, e, which in zip((character[starts[a:b] - low] - zero).tolist(), (character[ends[a:b] - low] - zero).tolist(), label[a:b].tolist()):
                if spans and spans[-1]["lang"] == languages[which]:
                    spans[-1]["end"] = e
                else:
                    spans.append({"start": s, "end": e, "lang": languages[which]})
        out.append(spans)
    return out


def learn(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = LANGUAGE_ROWS, size: int = LANGUAGE_BYTES) -> Model:
    """The model of the languages that rows where ``train`` holds are labelled with.

    It is fitted on a bounded sample: of each of the ``MOST_LANGUAGES`` most frequent
    languages ``rows`` rows, as long as their texts hold ``size`` bytes (one text at
    least). A language none of whose sampled texts has a letter is not learned.
    """
    with working(docs.sparkSession):
        return _learned(docs, train, id_col, text_col, lang_col, rows, size)


def _learned(docs: DataFrame, train: Column, id_col: str, text_col: str, lang_col: str, rows: int, size: int) -> Model:
    import numpy as np

    known = keyed(docs, id_col, text_col, lang=F.col(lang_col).cast("string"), train=train).filter("train AND lang IS NOT NULL")
    known = known.withColumn("mark", F.xxhash64("text"))
    frequent = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    # of a frequent language, only the share of the hashes is sent that has the rows wanted and some to spare
    share = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    enough = share * F.col("n") <= rows + 20 * rows**0.5 + 100
    marked = known.select("lang", "doc_id", "mark", F.octet_length("text").cast("long").alias("bytes")).join(F.broadcast(frequent), "lang").filter(enough)
    keys = marked.groupBy("lang", "doc_id", "mark").agg(F.max("bytes").alias("bytes"))
    by_hash = W.partitionBy("lang").orderBy(F.shiftrightunsigned(F.xxhash64("doc_id"), 11), "doc_id", "mark")
    keys = keys.withColumn("place", F.row_number().over(by_hash)).filter(F.col("place") <= rows)
    keys = keys.withColumn("upto", F.sum("bytes").over(by_hash.rowsBetween(W.unboundedPreceding, 0)))
    keys = written(keys.filter((F.col("upto") <= size) | (F.col("place") == 1)).select("lang", "doc_id", "mark", "bytes"), "language-sample")
    languages = [r.lang for r in keys.select("lang").distinct().orderBy("lang").collect()]  # MOST_LANGUAGES at most
    if not languages:
        return Model([], np.zeros((len(SCRIPTS) + 2, 0), bool), [])
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1
    # of a row that repeats, one copy counts
    texts = known.select("lang", "doc_id", "mark", "text").join(F.broadcast(keys.drop("bytes")), ["lang", "doc_id", "mark"], "left_semi")
    texts = texts.dropDuplicates(["lang", "doc_id", "mark"]).select(number.alias("language"), "text")
    counted = texts.mapInArrow(thrifty(_counts), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    key, n = (counted[c].to_numpy() for c in ("key", "n"))
    order = np.argsort(key)
    key, n = key[order], n[order]
    learned = sorted(set((key >> BITS + 3).tolist()))
    place = np.full(len(languages), -1)
    place[learned] = np.arange(len(learned))
    key = place[key >> BITS + 3] << BITS + 3 | key & (1 << BITS + 3) - 1
    return Model.of_counts([languages[i] for i in learned], key, n)


def identify(
    docs: DataFrame, parts: int = 4, part: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", detail: bool = False, switch: float = SWITCH
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row, and with ``detail`` its ``spans``.

    Rows outside the held-out part that have an id and a language are learned from;
    predictions look at texts alone. ``score`` is the share of a text's letters, in bytes,
    that are in words labelled with ``lang_pred`` (of equal shares, the first name). A text
    without letters, null and empty too, is ``und`` with score 0, and so is every text if
    no language was learned. ``spans`` holds ``start``, ``end`` (characters) and ``lang``.
    Rows that repeat are answered each, and learned from once. A row with a null id is in
    no part. An empty table gives an empty result; columns of other names do not matter.
    """
    held_out = fold(id_col, parts, part)
    model = learn(docs, F.col(id_col).isNotNull() & ~held_out, id_col, text_col, lang_col)
    source = keyed(docs, id_col, text_col, held_out=held_out)
    made = "lang_pred string, score double" + (", spans array<struct<start:long,end:long,lang:string>>" if detail else "")
    schema = T.StructType([source.schema["doc_id"], source.schema["held_out"], *T.StructType.fromDDL(made)])
    return source.mapInArrow(thrifty(_labelled(model, switch, detail, ["doc_id", "held_out"])), schema)
