"""Packing token ids of whole documents into windows of fixed size by minimum bin slack.

A document's ids fill whole windows of their own first; what remains is shorter than a window.
Windows for the remainders are chosen from how many there are of each length, a table with fewer
rows than a window has tokens, whatever the number of documents. Each window takes the longest
remainder left, and a subset sum over the rest picks the multiset that comes closest to the
capacity: a bitset of reachable sums, one shift for a power of two of equal lengths, up to the
first that reaches it, and counts by going back through the bitsets. A choice holds for as many
windows as the counts allow, so the choices number some thousands at most for any input. When no
sum fills a window, the longest remainder left is cut to fit and its rest goes back on the table.
What is left in the end, less than a window, becomes windows at powers of two, which need no
padding: no sequence has any.

Documents find their places without a common order: the n-th remainder of a length in the n-th
place for it. n is a task's own count plus those of the tasks before it, so a length that many
documents have is never gathered. The choices are sent to every task; their number doesn't grow
with the documents.

Null texts are empty documents (only the end id); a null doc_id is kept; repeated rows are packed
each; an empty table gives no rows; other columns are ignored. Very long texts are encoded in
sections of some million letters, cut at spaces.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm.common import KEPT, arrow_rows, lean, stored

#: Spellings between spaces that a worker remembers the ids of, and the longest kept.
CACHE_WORDS, CACHE_LETTERS = 600_000, 40
#: Letters of text that a worker splits at a time, and texts in an Arrow batch.
SECTION_LETTERS, BATCH_ROWS = 12_000_000, 4096
#: Texts in which case or marks may matter: special tokens and combining marks.
_FOLDS_NOT = r"<\||[\x{0300}-\x{036F}]"


class Encoder:
    """Ids of whole texts by a tokenizer that treats what lies between spaces by itself.

    That holds where white space is dropped and ends every word. Equal spellings of a slice are
    encoded once, and those met lately are remembered. Where case is dropped too, and marks at the
    end of a word are words of their own, ``Word,`` is read as ``word ,``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        plain = [
            (token.content, i)
            for i, token in self.tokenizer.get_added_tokens_decoder().items()
            if token.special and not (token.lstrip or token.rstrip or token.single_word)
        ]
        self.mark = max(plain, key=lambda x: x[1], default=("", -1))
        self.folds = self._encode(["Ab,", "a.?"]) == [
            b"".join(self._encode(x)) for x in (["ab", ","], ["a", ".?"])
        ]

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of each spelling; all in one text, if a special token can stand between them."""
        mark, mark_id = self.mark
        text = mark.join(words)
        if mark and text.count(mark) == len(words) - 1:
            (done,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(done.ids, self.dtype)
            edges = [-1, *np.flatnonzero(ids == mark_id).tolist(), len(ids)]
            return [ids[a + 1 : b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
        done = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in done]

    def _lookup(self, words: list[str]) -> list[bytes]:
        """Ids of each of the words, a list without repeats."""
        if len(self.known) > CACHE_WORDS:
            self.known, self.earlier = {}, self.known
        known = self.known
        found = list(map(known.get, words))
        new = [i for i, x in enumerate(found) if x is None]
        ids = list(map(self.earlier.get, [words[i] for i in new]))
        if unknown := [i for i, x in zip(new, ids, strict=True) if x is None]:
            learnt = iter(self._encode([words[i] for i in unknown]))
            ids = [next(learnt) if x is None else x for x in ids]
        for i, x in zip(new, ids, strict=True):
            found[i] = x
        known.update((words[i], found[i]) for i in new if len(words[i]) <= CACHE_LETTERS)
        return found

    def _spaced(self, texts: pa.Array) -> pa.Array:
        """The texts with a space before marks that end a word, and A-Z lower-cased."""
        spaced = pc.replace_substring(texts, "\n", " ")
        if not self.folds:
            return spaced
        low = pc.replace_substring_regex(
            pc.ascii_lower(spaced), r"([a-z])([.,;:!?]+)( |$)", r"\1 \2\3"
        )
        # Special tokens go by case, and a letter may only be composed with a mark in lower case.
        return pc.if_else(pc.match_substring_regex(spaced, _FOLDS_NOT), spaced, low)

    def _slice(self, texts: list[str]) -> list[bytes]:
        spaced = self._spaced(pa.array(texts, pa.large_string()))
        words = pc.split_pattern(spaced, " ")
        coded = words.flatten().dictionary_encode()
        found = self._lookup(coded.dictionary.to_pylist())
        width = np.dtype(self.dtype).itemsize
        # A slice has far fewer than 2^31 ids.
        each = np.fromiter(map(len, found), np.int32, len(found)) // width
        start = np.cumsum(each, dtype=np.int32) - each
        which = coded.indices.to_numpy()
        sizes = each[which]
        upto = np.concatenate([[0], np.cumsum(sizes, dtype=np.int32)]).astype(np.int32)
        at = np.repeat(start[which] - upto[:-1], sizes) + np.arange(upto[-1], dtype=np.int32)
        ids = np.frombuffer(b"".join(found), self.dtype)[at]
        edges = upto[words.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        done, group, size = [], [], 0
        for owner, section in _sections(texts):
            group.append((owner, section))
            size += len(section)
            if size > SECTION_LETTERS:
                done += zip([o for o, _ in group], self._slice([x for _, x in group]), strict=True)
                group, size = [], 0
        if group:
            done += zip([o for o, _ in group], self._slice([x for _, x in group]), strict=True)
        out = [[] for _ in texts]
        for owner, ids in done:
            out[owner].append(ids)
        return [b"".join(x) for x in out]


def _sections(texts: list[str]) -> Iterator[tuple[int, str]]:
    """Each text with its number; very long ones in several sections that begin at a space."""
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at > SECTION_LETTERS:
            end = text.find(" ", at + SECTION_LETTERS)
            if end < 0:
                break
            yield i, text[at:end]
            at = end
        yield i, text[at:] if at else text


def _encoder(path: str) -> Encoder:
    if path not in KEPT:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        KEPT[path] = Encoder(path)
    return KEPT[path]


def tokens(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, ids and n of each document, and its place in its task's counts.

    ``rank`` numbers the documents of one remainder in a part, ``wholes`` the whole windows of the
    part before the document. The table is stored: what a task counted once stays.
    """

    def encode(batches):
        encoder = _encoder(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        width = len(end)
        part, seen, wholes = TaskContext.get().partitionId(), Counter(), 0
        for batch in lean(batches, keep=tokenizer):
            ids = [x + end for x in encoder(batch["text"].to_pylist())]
            size = [len(x) // width for x in ids]
            rows = []
            for n in size:
                rows.append((seen[n % capacity], wholes))
                seen[n % capacity] += 1
                wholes += n // capacity
            rank, before = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(ids), pa.int32()),
                    batch["doc_id"],
                    pa.array(size, pa.int64()),
                    pa.array([n % capacity for n in size], pa.int32()),
                    pa.array(rank, pa.int64()),
                    pa.array(before, pa.int64()),
                    pa.array([width] * len(ids), pa.int8()),
                    pa.array(ids, pa.binary()),
                ],
                ["part", "doc_id", "n", "rest", "rank", "wholes", "width", "ids"],
            )

    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return stored(
            read.mapInArrow(
                encode,
                "part int, doc_id long, n long, rest int, rank long, wholes long, width byte, "
                "ids binary",
            ),
            "packing-tokens",
        )


def closest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take for the greatest sum of at most ``room``."""
    mask, goal = (1 << (room + 1)) - 1, 1 << room
    reach, steps = 1, []
    for length in lengths:
        if reach & goal:
            break
        left, some = min(counts[length], room // length), 1
        while left and not reach & goal:
            take = min(some, left)
            grown = reach | reach << length * take & mask
            if grown != reach:
                steps.append((length, take, reach))
                reach = grown
            left, some = left - take, some * 2
    at, picked = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            picked[length] = picked.get(length, 0) + take
    return picked


@dataclass(frozen=True)
class Place:
    """Where the documents ``first`` to ``first + count - 1`` of a remainder have one piece.

    It is ``length`` ids from ``start`` of the remainder on. Each window from ``window`` on holds
    ``each`` of them, side by side from ``offset`` on; ``skip`` come before these documents.
    """

    rest: int
    first: int
    count: int
    start: int
    length: int
    window: int
    each: int
    offset: int
    skip: int


class _Stock:
    """Remainders left of each length, as runs of documents of one original remainder."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {length: n for length, n in counts.items() if length > 0 and n > 0}
        self.runs = defaultdict(deque)
        for length, n in self.counts.items():
            self.runs[length].append((length, 0, 0, n))
        self.lengths = sorted(self.counts)

    def put(self, length: int, run: tuple[int, int, int, int]) -> None:
        if length not in self.counts:
            bisect.insort(self.lengths, length)
        self.counts[length] = self.counts.get(length, 0) + run[3]
        self.runs[length].append(run)

    def take(self, length: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.lengths.remove(length)
        runs = self.runs[length]
        while n:
            rest, start, first, count = runs.popleft()
            if count > n:
                runs.appendleft((rest, start, first + n, count - n))
                count = n
            yield rest, start, first, count
            n -= count


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Place], int]:
    """Places for ``counts`` of remainders, and the number of windows used."""
    stock, places, window = _Stock(counts), [], 0

    def fill(length: int, each: int, windows: int, offset: int) -> None:
        skip = 0
        for rest, start, first, count in stock.take(length, each * windows):
            places.append(Place(rest, first, count, start, length, window, each, offset, skip))
            skip += count

    while stock.lengths:
        longest = stock.lengths[-1]
        left = dict(stock.counts)
        left[longest] -= 1
        room = capacity - longest
        fitting = stock.lengths[: bisect.bisect_right(stock.lengths, room)][::-1]
        picked = closest([x for x in fitting if left[x]], left, room)
        picked[longest] = picked.get(longest, 0) + 1
        slack = capacity - sum(length * n for length, n in picked.items())
        # Whatever is still left is longer than the slack, or it would have been taken.
        cut = next((x for x in reversed(stock.lengths) if stock.counts[x] > picked.get(x, 0)), 0)
        if slack and not cut:
            return places + _last(stock, picked, window), window + bin(capacity - slack).count("1")
        uses = Counter(picked) + Counter({cut: 1} if slack else {})
        windows = min(stock.counts[length] // n for length, n in uses.items())
        offset = 0
        for length, each in sorted(picked.items(), reverse=True):
            fill(length, each, windows, offset)
            offset += length * each
        if slack:
            skip = 0
            for rest, start, first, count in list(stock.take(cut, windows)):
                places.append(Place(rest, first, count, start, slack, window, 1, offset, skip))
                stock.put(cut - slack, (rest, start + slack, first, count))
                skip += count
        window += windows
    return places, window


def _last(stock: _Stock, picked: dict[int, int], window: int) -> list[Place]:
    """The last remainders side by side, cut into windows at powers of two."""
    total = sum(length * n for length, n in picked.items())
    sizes = [1 << k for k in reversed(range(total.bit_length())) if total >> k & 1]
    places, used = [], 0
    for length in sorted(picked, reverse=True):
        for rest, start, first, count in stock.take(length, picked[length]):
            for document in range(first, first + count):
                at = 0
                while at < length:
                    some = min(length - at, sizes[0] - used)
                    places.append(
                        Place(rest, document, 1, start + at, some, window, 1, used, 0)
                    )
                    at, used = at + some, used + some
                    if used == sizes[0]:
                        sizes, used, window = sizes[1:], 0, window + 1
    return places


class Places:
    """The places of a document by its remainder and number."""

    def __init__(self, places: list[Place]):
        by_rest = defaultdict(list)
        for place in places:
            by_rest[place.rest].append(place)
        self.of = {}
        for rest, some in by_rest.items():
            edges = sorted({p.first for p in some} | {p.first + p.count for p in some})
            cells = [[] for _ in edges]
            for p in some:
                low = bisect.bisect_left(edges, p.first)
                for k in range(low, bisect.bisect_left(edges, p.first + p.count)):
                    cells[k].append(p)
            self.of[rest] = edges, [sorted(c, key=lambda p: p.start) for c in cells]

    def __call__(self, rest: int, number: int) -> Iterator[tuple[int, int, int, int]]:
        """start in the remainder, length, window and offset of each piece."""
        if rest:
            edges, cells = self.of[rest]
            for p in cells[bisect.bisect_right(edges, number) - 1]:
                window, slot = divmod(p.skip + number - p.first, p.each)
                yield p.start, p.length, p.window + window, p.offset + slot * p.length


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (4 bytes each), doc_tokens, sequence_id, offset."""
    held = tokens(docs, tokenizer, end_id, capacity)
    rests = held.groupBy("rest").agg(F.count(F.lit(1)).alias("n")).collect()
    places, windows = plan({row["rest"]: row["n"] for row in rests}, capacity)
    find = Places(places)

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("n").over(earlier.partitionBy("rest")), F.lit(0))
    by_rest = (
        held.groupBy("part", "rest")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", "rest", ahead.alias("rank_ahead"))
    )
    # One row a task: the only window without a key.
    by_part = (
        held.groupBy("part")
        .agg(F.sum(F.expr(f"n div {capacity}")).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("wholes_ahead"))
    )
    numbered = held.join(by_rest.join(by_part, "part"), ["part", "rest"]).select(
        "doc_id",
        "n",
        "rest",
        (F.col("rank") + F.col("rank_ahead")).alias("number"),
        (F.col("wholes") + F.col("wholes_ahead") + windows).alias("whole"),
        "width",
        "ids",
    )

    def place(batches):
        for batch in lean(batches):
            columns = [batch[name].to_pylist() for name in batch.schema.names]
            rows, size = [], 0
            for doc_id, n, rest, number, whole, width, raw in zip(*columns, strict=True):
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                whole_windows = n // capacity
                pieces = [(k * capacity, capacity, whole + k, 0) for k in range(whole_windows)]
                tail = whole_windows * capacity
                pieces += [(tail + at, *place) for at, *place in find(rest, number)]
                for start, length, window, offset in pieces:
                    held = ids[start : start + length].tobytes()
                    rows.append((doc_id, start, length, held, n, window, offset))
                size += 4 * n
                if size > 1 << 24:
                    yield _pieces(rows)
                    rows, size = [], 0
            yield _pieces(rows)

    return numbered.mapInArrow(place, _PIECE)


_PIECE = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long"
)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 7
    names = [column.split()[0] for column in _PIECE.split(", ")]
    kinds = [pa.binary() if name == "ids" else pa.int64() for name in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, n and ids of each sequence; one has no more pieces than a window has ids."""
    return (
        pieces.groupBy("sequence_id")
        .agg(
            F.sum("length").alias("n"),
            F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("pieces"),
        )
        .select(
            "sequence_id",
            "n",
            F.expr("aggregate(pieces.ids, X'', (held, ids) -> concat(held, ids))").alias("ids"),
        )
    )
