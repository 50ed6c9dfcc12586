"""Cost-balanced packing of tokenized documents into sequences of a fixed length.

The cost of a piece is linear in its length (the dense layers) plus quadratic (attention). Documents are dealt to
buckets by a digest; in a bucket the longest comes first and goes to the sequence of lowest cost that still has
room for all of it. A document longer than a sequence first fills sequences of its own; one that fits nowhere whole
is cut at the room of the emptiest sequence. The bucket's tokens fill whole sequences exactly; what is left over,
less than one sequence, is laid out in sequences whose lengths are powers of two, which need no padding.

Words are tokenized once per worker: the vocabulary's rules never join characters across white space, so a text's
ids are its words' ids in a row, and a bounded cache keeps the words met before. Ids are shuffled once, at two bytes
each where the vocabulary allows. A bucket holds about `bucket_docs` documents whatever the input's size.

Defined cases: a null or empty text is just the end id; every row is packed, repeated or not; an empty table gives no
rows. Further columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PackRules:
    """attention: cost of one pair of tokens in the unit of one token's linear cost; cached_words: words that a worker
    process remembers while it tokenizes; kept_words: words and pieces that stay with it once it fills sequences."""

    vocabulary: str
    length: int = 4096
    end_id: int = 2
    attention: float = 1 / 2048
    bucket_docs: int = 512
    cached_words: int = 1_000_000
    kept_words: int = 200_000


#: Words that a vocabulary of the plain kind treats letter by letter as is done here: all of Latin up to U+017F, but for
#: the dotted capital I, whose lower case is two characters.
LATIN = re.compile("[\\x21-\\u012f\\u0131-\\u017f]+").fullmatch


def byte_letters() -> dict[int, str]:
    """How vocabularies of bytes write the UTF-8 bytes of a letter beyond ASCII: printable bytes as the character of
    that number, the others as the characters from 256 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    letter = {b: chr(b) for b in shown}
    letter |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in letter)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x80, 0x180)}


class Words(dict):
    """Ids of words, found out when a word is first met; `encode` forgets all beyond a number of entries.

    Latin words, if the vocabulary only normalises to NFC and lower case and parts words by one pattern, are lower-cased
    and parted here and go straight to its merges; any other word goes through the whole tokenizer.
    """

    def __init__(self, rules: PackRules):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(rules.vocabulary)
        self.merge = self.tokenizer.model.tokenize
        wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.width, self.code = np.dtype("<u4" if wide else "<u2"), "I" if wide else "H"
        self.end = self.packed([rules.end_id])
        self.most = rules.cached_words
        self.pieces: dict[str, bytes] = {}
        self.letters = byte_letters()
        self.pattern = self._pattern()
        #: A run of letters is one piece, if the pattern says so.
        self.runs = self.pattern is not None and "[\\p{L}]+" in self.pattern.pattern.split("|")
        added = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.special = re.compile(added).search if added else lambda text: None

    def packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _pattern(self):
        """What parts words into pieces, or None if the vocabulary does more than that."""
        said = json.loads(self.tokenizer.to_str())
        steps = (said.get("normalizer") or {}).get("normalizers", [])
        parts = (said.get("pre_tokenizer") or {}).get("pretokenizers", [])
        plain = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": "\\s+"} and steps[1]["content"] == " "
        if not plain or [p["type"] for p in parts] != ["Split", "ByteLevel"]:
            return None
        split, level = parts
        if split["behavior"] != "Removed" or not split["invert"] or level["add_prefix_space"] or level["use_regex"]:
            return None
        return regex.compile(split["pattern"]["Regex"]) if "Regex" in split["pattern"] else None

    def piece(self, text: str) -> bytes:
        found = self.pieces.get(text)
        if found is None:
            shown = text if text.isascii() else text.translate(self.letters)
            found = self.pieces[text] = self.packed([t.id for t in self.merge(shown)])
        return found

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if self.pattern is None or not LATIN(text) or not text.isprintable() or self.special(text):
            found = self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        else:
            text = text.lower()
            found = self.piece(text) if self.runs and text.isalpha() else b"".join(map(self.piece, self.pattern.findall(text)))
        self[word] = found
        return found

    def release(self, most: int) -> None:
        if len(self) + len(self.pieces) > most:
            self.clear()
            self.pieces.clear()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self) > self.most:
            self.clear()
            self.pieces.clear()
        ids = self.__getitem__
        return [b"".join(map(ids, (t or "").encode("utf-8", "surrogatepass").split())) + self.end for t in texts]


_WORDS: dict[PackRules, Words] = {}


def words_of(rules: PackRules) -> Words:
    """One per worker process and rules, kept between tasks."""
    if rules not in _WORDS:
        _WORDS[rules] = Words(rules)
    return _WORDS[rules]


def tokenize(docs: DataFrame, rules: PackRules, buckets: int) -> DataFrame:
    """bucket, doc_id, ids (little-endian, 2 or 4 bytes each, the end id last)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(rules)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = words.encode(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ids, pa.binary())], names=["bucket", "doc_id", "ids"])

    bucket = F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int").alias("bucket")
    return docs.select(bucket, F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "bucket int, doc_id long, ids binary")


def assign(lengths: list[int], rules: PackRules) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one bucket's documents."""
    full, total = rules.length, sum(lengths)
    pieces, whole = [], 0
    items = []
    for doc, n in enumerate(lengths):
        for start in range(0, n - full + 1, full):
            pieces.append((doc, start, full, whole, 0))
            whole += 1
        if n % full:
            items.append((-(n % full), doc, n - n % full))
    heapq.heapify(items)
    open_ = total // full - whole
    left = total % full
    room = np.array([full] * open_ + [left] * bool(left), dtype=np.int64)
    cost = np.zeros(len(room))
    size = room.copy()
    last: list[tuple[int, int, int, int]] = []
    while items:
        n, doc, start = heapq.heappop(items)
        n = -n
        fits = room >= n
        if fits.any():
            at, take = int(np.where(fits, cost, np.inf).argmin()), n
        else:
            at = int(room.argmax())
            take = int(room[at])
            heapq.heappush(items, (take - n, doc, start + take))
        offset = int(size[at] - room[at])
        room[at] -= take
        cost[at] += take + rules.attention * take * take
        if at == open_:
            last.append((doc, start, take, offset))
        else:
            pieces.append((doc, start, take, whole + at, offset))
    # The last sequence is cut into powers of two, largest first.
    bounds, at = [], 0
    for power in range(left.bit_length() - 1, -1, -1):
        if left >> power & 1:
            bounds.append((at, at + (1 << power)))
            at += 1 << power
    for k, (low, high) in enumerate(bounds):
        for doc, start, n, offset in last:
            a, b = max(low, offset), min(high, offset + n)
            if a < b:
                pieces.append((doc, start + a - offset, b - a, whole + open_ + k, a - low))
    return pieces


PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, rules: PackRules) -> DataFrame:
    """One row per piece of `docs` (doc_id, text): where it lies in which sequence, and its ids (4 bytes each)."""
    buckets = max(1, -(-docs.count() // rules.bucket_docs))

    def fill(rows: pa.Table) -> pa.Table:
        words = words_of(rules)
        # All texts are tokenized by now, and the process goes on to other work.
        words.release(rules.kept_words)
        bucket, ids = rows["bucket"][0].as_py(), [np.frombuffer(x, dtype=words.width) for x in rows["ids"].to_pylist()]
        # The order of rows in a group is not fixed: documents go by their ids' bytes, so that reruns agree.
        names = rows["doc_id"].to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (names[i] is None, names[i] or 0, ids[i].tobytes()))
        out = assign([len(ids[i]) for i in order], rules)
        docs_ = [order[p[0]] for p in out]
        return pa.table({
            "doc_id": pa.array([names[d] for d in docs_], pa.int64()),
            "start": pa.array([p[1] for p in out], pa.int64()),
            "length": pa.array([p[2] for p in out], pa.int64()),
            "doc_tokens": pa.array([len(ids[d]) for d in docs_], pa.int64()),
            "sequence_id": pa.array([(bucket << 32) + p[3] for p in out], pa.int64()),
            "offset": pa.array([p[4] for p in out], pa.int64()),
            "ids": pa.array([ids[d][p[1] : p[1] + p[2]].astype("<u4").tobytes() for d, p in zip(docs_, out)], pa.binary()),
        })

    return tokenize(docs, rules, buckets).groupBy("bucket").applyInArrow(fill, PIECES)


