"""Brown class-based bigram scores: exchange clustering, class transitions and word emissions.

Every word met at least `placed` times in training is a unit of its own, so units grow with the corpus; a rarer word is
stood for by its last three characters, if rare words of that ending are met as often, and else by one common rest. So
every word, met or not, has a unit. Exchange clustering starts on the driver with at most 2 x `heads` + 2
representatives (words and endings of at least 1 / `heads` of all training words, and a rest): one after the other moves
to the class that gives the training text the highest likelihood, until a sweep moves none. Units begin in the class of
their representative. Then rounds run over the whole corpus: the classes beside every unit are counted, added up in
blocks of units, and each block moves its units one after the other. Words that were representatives stay put, and of
the others every second one in a round, as moves do not see what becomes of the words beside them. A round that does
not raise the likelihood is undone.

A word's probability is P(class | class before) x P(word | class): transitions are smoothed with the class's own share,
and a class keeps for words not met as much as it has words met once. That is mixed with a small part of the smoothed
unigram. Unknown words of a class are one event, as in the unigram, so probabilities add up to one.

Texts are cut into chunks of bounded size that hold each word once and the text as numbers. Only the chunks' word
lists are shuffled by word, for exact counts over the corpus, and come back to their chunk; a word has one row per
chunk, however frequent it is. Representatives and transitions are of bounded size and go to all tasks, and so does
the class of every unit, a byte each; the units' words stay in tables.

Defined cases: a null or empty text is the end token alone; a null doc_id is a training row; repeated rows are scored and
counted each; without training rows every word is unknown and the base score is 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import settle
from jobtide.session import local_frame

END = b""
REST, STOP = 0, 1
# Blocks of units whose counts travel together; counts and tokens that a task adds up before it hands them on; tokens scored at once.
SPAN, MOST_COUNTS, MOST_HELD, SCORED_TOKENS = 16, 1 << 20, 1 << 30, 1 << 17


@dataclass(frozen=True)
class LmRules:
    """placed: times a word is met to be a unit; heads bounds representatives; classes (256 at most); sweeps of exchange
    on representatives and rounds on units at most; units in a block; chunk in bytes of text."""

    placed: int = 20
    heads: int = 1000
    ending: int = 3
    classes: int = 48
    sweeps: int = 8
    rounds: int = 4
    block: int = 256
    chunk_bytes: int = 8 << 20
    unigram_part: float = 0.02
    transition_prior: float = 20.0


def pack(numbers: np.ndarray, level: int = 1) -> bytes:
    """Numbers compressed, all their lowest bytes first."""
    return zstandard.ZstdCompressor(level).compress(np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T.tobytes())


def unpack(packed: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


CHUNK = "chunk long, doc_ids array<long>, held array<boolean>, tokens array<int>, ids binary, words binary"


def chunks(docs: DataFrame, held_out: Column, rules: LmRules) -> DataFrame:
    """Rows of many documents: their token numbers within the chunk, and the chunk's words in that order.

    Number 0 is the end token. Words hold no white space, so they are kept joined by blanks.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, packer = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(3)
        rows: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            doc_ids, texts, held = (pa.concat_arrays([r.column(i) for r in rows]) for i in range(3))
            pieces = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
            # Blanks at the ends of a text leave empty pieces.
            real = pc.not_equal(pieces.flatten(), "")
            so_far = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int32)])
            n_words = np.diff(so_far[pieces.offsets.to_numpy()])
            coded = pc.dictionary_encode(pieces.flatten().filter(real))
            ids = np.insert(coded.indices.to_numpy() + np.int32(1), np.cumsum(n_words), 0)
            words = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary) + 1], pa.concat_arrays([pa.array([""], texts.type), coded.dictionary])), " ")[0]
            columns = [pa.array([(part << 32) + made]), *[pa.ListArray.from_arrays([0, len(x)], x) for x in (doc_ids, held, pa.array(n_words + 1, pa.int32()))]]
            return pa.RecordBatch.from_arrays([*columns, pa.array([pack(ids, 3)], pa.binary()), pa.array([packer.compress(words.as_buffer())], pa.binary())], names=["chunk", "doc_ids", "held", "tokens", "ids", "words"])

        size = 0
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            at = gone = 0
            while at < batch.num_rows:
                # As far as the row that fills the chunk.
                stop = min(int(np.searchsorted(ends, gone + rules.chunk_bytes - size)) + 1, batch.num_rows)
                rows.append(batch.slice(at, stop - at))
                size += int(ends[stop - 1]) - gone
                at, gone = stop, int(ends[stop - 1])
                if size >= rules.chunk_bytes:
                    yield out()
                    made += 1
                    rows, size = [], 0
        if rows:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    return rows.mapInArrow(task, CHUNK)


@dataclass
class Chunk:
    """One chunk read back."""

    words: list[bytes]
    ids: np.ndarray
    tokens: np.ndarray
    held: np.ndarray

    @classmethod
    def of(cls, ids: bytes, words: bytes, tokens: list[int], held: list[bool]) -> "Chunk":
        return cls(
            zstandard.ZstdDecompressor().decompress(words).split(b" "), unpack(ids, np.int32),
            np.array(tokens, dtype=np.int64), np.array(held, dtype=bool),
        )

    @property
    def trains(self) -> np.ndarray:
        """Per token, whether its document is learned from."""
        return np.repeat(~self.held, self.tokens)


def read_chunks(batch: pa.RecordBatch) -> Iterator[Chunk]:
    names = ("ids", "words", "tokens", "held")
    for i in range(batch.num_rows):
        yield Chunk.of(*[batch.column(batch.schema.get_field_index(n))[i].as_py() for n in names])


def word_lists(held: DataFrame) -> DataFrame:
    """word, chunk, at (its number there), n (times in training texts there)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, c in enumerate(read_chunks(batch)):
                n = np.bincount(c.ids[c.trains], minlength=len(c.words))
                chunk = np.full(len(c.words), batch.column(0)[i].as_py(), dtype=np.int64)
                whole = pa.RecordBatch.from_arrays(
                    [pa.array([w.decode("utf-8", "replace") for w in c.words]), pa.array(chunk), pa.array(np.arange(len(chunk), dtype=np.int32)), pa.array(n.astype(np.int64))],
                    names=["word", "chunk", "at", "n"],
                )
                yield from (whole.slice(k, 65536) for k in range(0, whole.num_rows, 65536))

    return held.select("chunk", "ids", "words", "tokens", "held").mapInArrow(task, "word string, chunk long, at int, n long")


@dataclass(frozen=True)
class Representatives:
    """Numbers of frequent words and of frequent endings of other words."""

    words: dict[bytes, int]
    endings: dict[str, int]
    ending: int

    @property
    def size(self) -> int:
        return 2 + len(self.words) + len(self.endings)

    def of(self, words: list[bytes]) -> np.ndarray:
        get, ends, n = self.words.get, self.endings.get, self.ending
        found = [get(w, -1) for w in words]
        return np.array([f if f >= 0 else STOP if w == END else ends(w.decode("utf-8", "replace")[-n:], REST) for w, f in zip(words, found)], dtype=np.int64)


def representatives(vocabulary: DataFrame, total: int, rules: LmRules) -> Representatives:
    """From word, c: at most `heads` words and as many endings have the share that is asked for."""
    least = max(1, -(-total // rules.heads))
    named = vocabulary.where("c > 0 and word <> ''")
    words = sorted(r[0] for r in named.where(F.col("c") >= least).select("word").collect())
    ends = named.where(F.col("c") < least).groupBy(F.substring("word", -rules.ending, rules.ending).alias("e")).agg(F.sum("c").alias("c"))
    endings = sorted(r[0] for r in ends.where(F.col("c") >= least).select("e").collect())
    return Representatives(
        {w.encode(): i + 2 for i, w in enumerate(words)}, {e: i + 2 + len(words) for i, e in enumerate(endings)}, rules.ending
    )


def pair_counts(held: DataFrame, reps: Representatives) -> DataFrame:
    """before, counts (binary longs, one per representative that follows): over all training texts."""
    size = reps.size

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            for c in read_chunks(batch):
                now = reps.of(c.words)[c.ids]
                pair = np.concatenate([[STOP], now[:-1]]) * size + now
                total += np.bincount(pair[c.trains], minlength=size * size)
        rows = total.reshape(size, size)
        used = np.flatnonzero(rows.any(axis=1))
        packer = zstandard.ZstdCompressor(1)
        for k in range(0, len(used), 256):
            at = used[k : k + 256]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([packer.compress(rows[i].tobytes()) for i in at], pa.binary())], names=["before", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        reader = zstandard.ZstdDecompressor()
        total = sum(np.frombuffer(reader.decompress(x), dtype=np.int64) for x in rows["counts"].to_pylist())
        return pa.table({"before": rows["before"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    parts = held.select("ids", "words", "tokens", "held").mapInArrow(task, "before int, counts binary")
    return parts.groupBy("before").applyInArrow(add, "before int, counts binary")


def _g(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _move(table: np.ndarray, left: np.ndarray, right: np.ndarray, own: float, a: int) -> int:
    """The best class of one of class a, with the classes before and after it and its pairs with itself; changes all three tables."""
    right[a] -= own
    left[a] -= own
    table[a] -= right
    table[:, a] -= left
    table[a, a] -= own
    rows, columns, corner = table.sum(axis=1), table.sum(axis=0), np.diag(table)
    gain = (_g(table + right) - _g(table)).sum(axis=1) + (_g(table.T + left) - _g(table.T)).sum(axis=1)
    # A class's pair with itself takes both sides at once.
    gain += _g(corner + right + left + own) - _g(corner + right) - _g(corner + left) + _g(corner)
    gain -= _g(rows + right.sum() + own) - _g(rows) + _g(columns + left.sum() + own) - _g(columns)
    b = int(gain.argmax())
    b = a if gain[b] <= gain[a] + 1e-9 else b
    table[b] += right
    table[:, b] += left
    table[b, b] += own
    return b


def exchange(counts: np.ndarray, rules: LmRules) -> np.ndarray:
    """The class of each representative. counts[u, v]: how often v follows u."""
    size, k = len(counts), min(rules.classes, len(counts))
    often = counts.sum(axis=0) + counts.sum(axis=1)
    order = np.argsort(-often, kind="stable")
    of = np.zeros(size, dtype=np.int64)
    of[order] = np.arange(size) % k
    one_hot = np.zeros((size, k))
    one_hot[np.arange(size), of] = 1
    table = one_hot.T @ counts @ one_hot
    for _ in range(rules.sweeps):
        moved = 0
        for w in order:
            right = np.bincount(of, weights=counts[w], minlength=k)
            left = np.bincount(of, weights=counts[:, w], minlength=k)
            if not right.any() and not left.any():
                continue
            a = of[w]
            b = _move(table, left, right, float(counts[w, w]), a)
            moved += b != a
            of[w] = b
        if not moved:
            break
    return of


def units_of(vocabulary: DataFrame, total: int, reps: Representatives, of: np.ndarray, rules: LmRules) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """key, unit of the words and endings that are units, the class each begins in, and which stay there; key as `_key` has it."""
    least = _least(total, rules)
    keys = settle(vocabulary.where("c > 0 and word <> ''").groupBy(_key(least, rules).alias("key")).agg(F.sum("c").alias("c")).where(F.col("c") >= least).select("key"))
    parts = max(1, -(-keys.count() // 200_000))
    dealt = settle(
        keys.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")).withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy("key")))
    )

    def begin(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows["place"].to_numpy())
        names = [rows["key"][int(i)].as_py() for i in order]
        rep = [int(reps.of([k[1:].encode()])[0]) if k[0] == "w" else reps.endings.get(k[1:], REST) for k in names]
        return pa.table({"part": rows["part"].slice(0, 1), "classes": pa.array([of[rep].astype(np.uint8).tobytes()], pa.binary()), "stays": pa.array([bytes(k[0] == "w" and k[1:].encode() in reps.words for k in names)], pa.binary())})

    begun = sorted(dealt.groupBy("part").applyInArrow(begin, "part int, classes binary, stays binary").collect())
    first, at = {}, 2
    for part, classes, _ in begun:
        first[part], at = at, at + len(classes)
    offsets = local_frame(vocabulary.sparkSession, list(first.items()), "part int, first int")
    numbered = dealt.join(F.broadcast(offsets), "part").select("key", (F.col("first") + F.col("place") - 1).cast("int").alias("unit"))
    start = np.concatenate([of[[REST, STOP]].astype(np.uint8), *[np.frombuffer(c, dtype=np.uint8) for _, c, _ in begun]])
    return numbered, start, np.concatenate([[True, True], *[np.frombuffer(x, dtype=bool) for _, _, x in begun]])


def _least(total: int, rules: LmRules) -> int:
    """Times a unit is met; in a small corpus no more than a representative."""
    return min(rules.placed, max(1, -(-total // rules.heads)))


def _key(least: int, rules: LmRules) -> Column:
    """A frequent word, or the ending of another, told apart by the first letter."""
    return F.when(F.col("c") >= least, F.concat(F.lit("w"), "word")).otherwise(F.concat(F.lit("e"), F.substring("word", -rules.ending, rules.ending)))


def tagged(held: DataFrame, lists: DataFrame, numbered: DataFrame, total: int, rules: LmRules) -> DataFrame:
    """The chunks with unit and count of each of their words, and the units of words counted once that are first listed there."""
    least, salts = _least(total, rules), 16
    # An ending stands for many words, so its rows are dealt to several places.
    salt = F.when(F.col("c") >= least, 0).otherwise(F.pmod(F.xxhash64("word", "chunk"), F.lit(salts)).cast("int"))
    salted = numbered.withColumn("salt", F.explode(F.when(F.col("key").startswith("e"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    # Few and narrow columns, as there is a row for each word of a chunk; the end token has no key, a word counted once is marked by its sign.
    once = F.when(F.col("is_first") & (F.col("c") == 1) & (F.col("word") != ""), F.lit(-1)).otherwise(F.col("c"))
    rows = lists.select("chunk", "at", once.alias("n"), F.when(F.col("word") != "", _key(least, rules)).alias("key"), salt.alias("salt")).join(salted, ["key", "salt"], "left")
    unit = F.when(F.col("key").isNull(), F.lit(STOP)).otherwise(F.coalesce("unit", F.lit(REST)))
    rows = rows.select("chunk", "n", (F.shiftleft(F.col("at").cast("long"), 32) + unit).alias("place"))

    def task(texts: pa.Table, found: pa.Table) -> pa.Table:
        place, n = found["place"].to_numpy(), found["n"].to_numpy()
        at, unit = place >> 32, (place & 0xFFFFFFFF).astype(np.int32)
        units, counts = np.zeros(len(at), dtype=np.int32), np.zeros(len(at), dtype=np.int64)
        units[at], counts[at] = unit, np.abs(n)
        packer = zstandard.ZstdCompressor(3)
        packed = {"units": units, "counts": counts, "single": unit[n < 0]}
        return pa.table({**{c: texts[c] for c in ("doc_ids", "held", "tokens", "ids")}, **{k: pa.array([packer.compress(v.tobytes())], pa.binary()) for k, v in packed.items()}})

    schema = "doc_ids array<long>, held array<boolean>, tokens array<int>, ids binary, units binary, counts binary, single binary"
    return held.drop("words").groupBy("chunk").cogroup(rows.groupBy("chunk")).applyInArrow(task, schema)


def _cell(batch: pa.RecordBatch, row: int, name: str) -> bytes:
    return batch.column(batch.schema.get_field_index(name))[row].as_py()


def _numbers(batch: pa.RecordBatch, row: int, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(_cell(batch, row, name)), dtype=kind)


def _tokens(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each document of a chunk, and whether it is held out."""
    tokens, held = (batch.column(batch.schema.get_field_index(n))[row].as_py() for n in ("tokens", "held"))
    return np.array(tokens, dtype=np.int64), np.array(held, dtype=bool)


def counts_beside(units: np.ndarray, ids: np.ndarray, trains: np.ndarray, of: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """What stands before, and then behind, the units of a chunk, without zeros: places in ascending order, and counts.

    A unit has 2 x k + 1 places: classes before it, classes after it, and its pairs with itself.
    """
    local, number = np.unique(units, return_inverse=True)
    width = 2 * k + 1
    kind = np.int32 if len(local) * width < 1 << 31 else np.int64
    now = number.astype(kind)[ids]
    before = np.concatenate([np.searchsorted(local, [STOP]).astype(kind), now[:-1]])
    now, before = now[trains], before[trains]
    classes = of[local].astype(kind)
    for side in (0, 1):
        places = before * width + (k + classes[now]) if side else np.concatenate([now * width + classes[before], now[now == before] * width + 2 * k])
        places.sort()
        starts = np.flatnonzero(np.diff(places, prepend=kind(-1)))
        counts = np.diff(starts, append=len(places)).astype(np.int32)
        found, at = np.divmod(places[starts], kind(width))
        yield local[found].astype(np.int64) * width + at, counts


def added(parts: list[tuple[np.ndarray, np.ndarray]], each: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The counts of several parts added up: for each range of `each` places its number, the places and their counts."""
    for span in np.unique(np.concatenate([np.unique(places // each) for places, _ in parts])).tolist():
        cuts = [slice(*np.searchsorted(places, [span * each, (span + 1) * each])) for places, _ in parts]
        places, counts = (np.concatenate([part[i][cut] for part, cut in zip(parts, cuts)]) for i in (0, 1))
        order = np.argsort(places, kind="stable")
        starts = np.flatnonzero(np.diff(places[order], prepend=-1))
        yield span, places[order[starts]], np.add.reduceat(counts[order], starts, dtype=np.int32)


def add_counts(held: dict[int, np.ndarray], units: np.ndarray, ids: np.ndarray, trains: np.ndarray, of: np.ndarray, k: int, size: int) -> None:
    """Add to the blocks in `held` what stands beside the units of a chunk."""
    each = size * (2 * k + 1)
    for b, places, counts in added([*counts_beside(units, ids, trains, of, k)], each):
        if b not in held:
            held[b] = np.zeros((size, 2 * k + 1), dtype=np.int32)
        held[b].ravel()[places - b * each] += counts


def beside(texts: DataFrame, of: np.ndarray, k: int, rules: LmRules) -> DataFrame:
    """block, counts: per unit of a block the classes before it, the classes after it, and its pairs with itself.

    Tasks hand on no zeros, so what is counted and shuffled grows with the texts, however many blocks there are.
    """
    shared, each = texts.sparkSession.sparkContext.broadcast(of), SPAN * rules.block * (2 * k + 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, seen = [], 0, 0

        def out() -> pa.RecordBatch:
            packed = [(s, pack(np.diff(places, prepend=s * each).astype(np.int32)), pack(counts)) for s, places, counts in added(parts, each)]
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in packed], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["span", "steps", "counts"])

        for batch in batches:
            for i in range(batch.num_rows):
                tokens, is_held = _tokens(batch, i)
                # Counts are kept in 32 bits until they are handed on.
                if parts and (size > MOST_COUNTS or seen + int(tokens.sum()) > MOST_HELD):
                    yield out()
                    parts, size, seen = [], 0, 0
                trains = np.repeat(~is_held, tokens)
                parts += counts_beside(_numbers(batch, i, "units", np.int32), unpack(_cell(batch, i, "ids"), np.int32), trains, shared.value, k)
                size, seen = sum(len(places) for places, _ in parts), seen + int(tokens.sum())
        if parts:
            yield out()

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, span = np.zeros(each, dtype=np.int64), key[0].as_py()
        for batch in batches:
            for i in range(batch.num_rows):
                total[np.cumsum(unpack(_cell(batch, i, "steps"), np.int32))] += unpack(_cell(batch, i, "counts"), np.int32)
        blocks, packer = total.reshape(SPAN, -1), zstandard.ZstdCompressor(1)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(span * SPAN + used, pa.int32()), pa.array([packer.compress(blocks[b].tobytes()) for b in used], pa.binary())], names=["block", "counts"])

    parts = texts.select("held", "tokens", "ids", "units").mapInArrow(task, "span int, steps binary, counts binary")
    return settle(parts.groupBy("span").applyInArrow(add, "block int, counts binary"))


def _blocks(batches: Iterator[pa.RecordBatch], of: np.ndarray, k: int, rules: LmRules) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, counts and classes of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            block = batch.column(0)[i].as_py()
            classes = of[block * rules.block : (block + 1) * rules.block].astype(np.int64)
            yield block, _numbers(batch, i, "counts", np.int64).reshape(-1, 2 * k + 1)[: len(classes)], classes


def class_table(counted: DataFrame, of: np.ndarray, k: int, rules: LmRules) -> np.ndarray:
    """How often each class follows each."""
    shared = counted.sparkSession.sparkContext.broadcast(of)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((k, k), dtype=np.int64)
        for _, counts, classes in _blocks(batches, shared.value, k, rules):
            np.add.at(table, classes, counts[:, k : 2 * k])
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary())], names=["counts"])

    found = counted.mapInArrow(task, "counts binary").collect()
    return sum((np.frombuffer(r[0], dtype=np.int64).reshape(k, k) for r in found), np.zeros((k, k), dtype=np.int64)).astype(float)


def moved(counted: DataFrame, table: np.ndarray, of: np.ndarray, stays: np.ndarray, turn: int, rules: LmRules) -> np.ndarray:
    """The classes after a round in which every second unit may move, if it does not stay."""
    shared, k = counted.sparkSession.sparkContext.broadcast((of, table, stays)), len(table)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table, stays = shared.value
        for block, counts, classes in _blocks(batches, of, k, rules):
            mine = table.copy()
            for w in range((turn + block * rules.block) % 2, len(classes), 2):
                if not stays[block * rules.block + w] and counts[w].any():
                    classes[w] = _move(mine, counts[w, :k].astype(float), counts[w, k : 2 * k].astype(float), float(counts[w, 2 * k]), classes[w])
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([classes.astype(np.uint8).tobytes()], pa.binary())], names=["block", "classes"])

    after = of.copy()
    for block, classes in counted.mapInArrow(task, "block int, classes binary").collect():
        after[block * rules.block : block * rules.block + len(classes)] = np.frombuffer(classes, dtype=np.uint8)
    return after


def likelihood(table: np.ndarray) -> float:
    """What classes add to the log likelihood of the training text."""
    return float(_g(table).sum() - _g(table.sum(axis=1)).sum() - _g(table.sum(axis=0)).sum())


def settled_classes(texts: DataFrame, of: np.ndarray, stays: np.ndarray, k: int, rules: LmRules) -> tuple[np.ndarray, np.ndarray]:
    """The units' classes after the rounds, and the table of those classes."""
    counted = beside(texts, of, k, rules)
    table = class_table(counted, of, k, rules)
    for turn in range(rules.rounds):
        after = moved(counted, table, of, stays, turn, rules)
        if (after == of).all():
            continue
        counted_after = beside(texts, after, k, rules)
        table_after = class_table(counted_after, after, k, rules)
        if likelihood(table_after) > likelihood(table):
            of, table, counted = after, table_after, counted_after
    return of, table


@dataclass(frozen=True)
class ClassModel:
    """of: class of each unit; transition[a, b]; size and share of unmet words of each class; corpus sums."""

    of: np.ndarray
    transition: np.ndarray
    class_tokens: np.ndarray
    unmet: np.ndarray
    total: int
    distinct: int
    unigram_part: float

    def token_scores(self, classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probabilities of a run of tokens: by the unigram, and by the class model."""
        base = (counts + 0.1) / (self.total + 0.1 * (self.distinct + 1))
        before = np.concatenate([[self.of[STOP]], classes[:-1]])
        met = (1 - self.unmet[classes]) * counts / np.maximum(self.class_tokens[classes], 1)
        word = np.where(counts > 0, met, self.unmet[classes])
        plain = np.where(counts > 0, base, base / len(self.class_tokens))
        mixed = (1 - self.unigram_part) * self.transition[before, classes] * word + self.unigram_part * plain
        return np.log10(base), np.log10(mixed)


def fit(held: DataFrame, lists: DataFrame, rules: LmRules) -> tuple[DataFrame, ClassModel]:
    """The tagged chunks and the model of the training texts. lists: word, chunk, at, c, is_first."""
    vocabulary = lists.where("is_first").select("word", "c")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    reps = representatives(vocabulary, total, rules)
    counts = np.zeros((reps.size, reps.size))
    for before, row in pair_counts(held, reps).collect():
        counts[before] = np.frombuffer(row, dtype=np.int64)
    of = exchange(counts, rules)
    k = int(of.max()) + 1
    numbered, start, stays = units_of(vocabulary, total, reps, of, rules)
    texts = settle(tagged(held, lists, numbered, total, rules))
    of, table = settled_classes(texts, start, stays, k, rules)
    tokens = table.sum(axis=0)
    share = (tokens + 0.1) / (tokens.sum() + 0.1 * k)
    transition = (table + rules.transition_prior * share) / (table.sum(axis=1, keepdims=True) + rules.transition_prior)
    once = singles(texts, of, k)
    return texts, ClassModel(of, transition, tokens, np.minimum((once + 0.5) / (tokens + 1.0), 0.9), total, distinct, rules.unigram_part)


def singles(texts: DataFrame, of: np.ndarray, k: int) -> np.ndarray:
    """Words met once, per class."""
    shared = texts.sparkSession.sparkContext.broadcast(of)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = np.zeros(k, dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                once += np.bincount(shared.value[_numbers(batch, i, "single", np.int32)], minlength=k)
        yield pa.RecordBatch.from_arrays([pa.array([once.tobytes()], pa.binary())], names=["counts"])

    found = texts.select("single").mapInArrow(task, "counts binary").collect()
    return sum((np.frombuffer(r[0], dtype=np.int64) for r in found), np.zeros(k, dtype=np.int64)).astype(float)


def scored(texts: DataFrame, model: ClassModel) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                tokens, held = _tokens(batch, i)
                ids, counts = unpack(_cell(batch, i, "ids"), np.int32), _numbers(batch, i, "counts", np.int64)
                classes = m.of[_numbers(batch, i, "units", np.int32)]
                starts = np.concatenate([[0], np.cumsum(tokens)[:-1]])
                known, base, score = np.zeros(len(tokens), dtype=np.int64), np.zeros(len(tokens)), np.zeros(len(tokens))
                # Whole documents at once, each of which begins behind an end token.
                cuts = np.flatnonzero(np.diff(starts // SCORED_TOKENS, prepend=-1))
                for lo, hi in zip(cuts, [*cuts[1:], len(tokens)]):
                    here = ids[starts[lo] : starts[hi - 1] + tokens[hi - 1]]
                    inside, n = starts[lo:hi] - starts[lo], counts[here]
                    by_token = m.token_scores(classes[here].astype(np.int64), n)
                    base[lo:hi], score[lo:hi] = (np.add.reduceat(x, inside) for x in by_token)
                    known[lo:hi] = np.add.reduceat((n > 0).astype(np.int64), inside)
                columns = {
                    "doc_id": pa.array(batch.column(0)[i].as_py(), pa.int64()),
                    "held_out": pa.array(held),
                    "n_tokens": pa.array(tokens),
                    "n_known": pa.array(known),
                    "train_tokens": pa.array(np.full(len(tokens), m.total, dtype=np.int64)),
                    "base_score": pa.array(base),
                    "score": pa.array(score),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.select("doc_ids", "held", "tokens", "ids", "units", "counts").mapInArrow(task, schema)


def score_documents(docs: DataFrame, held_out: Column, rules: LmRules = LmRules()) -> DataFrame:
    """Learn from the rows of `docs` (doc_id, text) that are not held out, and score all of them."""
    held = settle(chunks(docs, held_out, rules))
    word = Window.partitionBy("word")
    # In this order one sort of the rows serves both.
    counted = word_lists(held).withColumn("is_first", F.row_number().over(word.orderBy("chunk")) == 1).withColumn("c", F.sum("n").over(word))
    lists = settle(counted.select("word", "chunk", "at", "c", "is_first"), "zstd")
    return scored(*fit(held, lists, rules))
