"""Best-fit packing of documents into sequences by bin completion.

Documents become runs of token ids (an end id after each); a run longer than a sequence
is cut into full pieces, of which the first may be shorter. Piece lengths lie between 1
and the sequence length, so their histogram is small whatever the corpus size. Bin
completion works on that histogram: around the largest length left it enumerates fillings
of the remaining room by rising waste, leaves those whose waste cannot beat the incumbent
and drops dominated ones (a filling that leaves room for another piece, or that has smaller
pieces where a larger one fits). A filling is used as often as the counts allow, then less
often, and the search backtracks until the bound is met. Pieces then find their place
by their number among pieces of the same length, in parallel.
"""

from __future__ import annotations

import os
import random
import zlib
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import CACHE_BYTES, PieceCache, byte_letters, slices
from .common import ranked, stored
from .shingles import text_bytes

#: Fillings that the search over sequences visits at most before the incumbent wins.
SEARCH_NODES = 20_000

_ENCODERS: dict[str, PieceCache] = {}


def encoder(path: str) -> PieceCache:
    """Ids by the tokenizers library, once a worker. It encodes the pieces that are new to the worker, many in one text."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        special = {x.content: i for i, x in t.get_added_tokens_decoder().items()}
        strings = [b""] * (1 + max(t.get_vocab().values()))
        for token, i in t.get_vocab().items():
            strings[i] = token.encode() if token in special else bytes(back[c] for c in token)
        opens = np.array([x.startswith(b" ") for x in strings])

        def encode(texts: list[str]) -> list[bytes]:
            return [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch_fast(texts, add_special_tokens=False)]

        def run(pieces: list[str]) -> list[bytes]:
            """Pieces that hold one space, at their start, go as one text: only their first tokens start with a space."""
            out: list[bytes] = [b""] * len(pieces)
            spaced = [i for i, p in enumerate(pieces) if p[0] == " " and p.rfind(" ") == 0 and len(p) <= CACHE_BYTES and not any(x in p for x in special)]
            spaced = [i for i in spaced if len(pieces[i]) > 1 and not pieces[i][1].isspace() and not pieces[i][-1].isspace()]
            for at in range(0, len(spaced), 5000):
                part = spaced[at : at + 5000]
                ids = encode(["".join([pieces[i] for i in part])])[0]
                starts = (4 * np.flatnonzero(opens[np.frombuffer(ids, "<u4")])).tolist()
                if len(starts) == len(part) and starts[0] == 0:
                    for i, a, b in zip(part, starts, [*starts[1:], len(ids)], strict=True):
                        out[i] = ids[a:b]
            rest = [i for i, x in enumerate(out) if not x]
            for i, x in zip(rest, encode([pieces[i] for i in rest]), strict=True):
                out[i] = x
            return out

        _ENCODERS[path] = PieceCache(run, strings, special)
    return _ENCODERS[path]


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full ones, after a first one that may be shorter."""
    first = n % size or min(n, size)
    return [(0, first), *((s, size) for s in range(first, n, size))]


def pieces_of(docs: DataFrame, path: str, size: int, end_id: int, with_ids: bool, id_col: str, text_col: str) -> DataFrame:
    """One row per piece: id_col, piece, start, length, ids_crc32 and, if asked for, ids."""
    docs = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    id_type = docs.schema["_id"].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            base = 0
            for texts in slices(batch.column(1)):
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                every, at_text = enc.encode(*text_bytes(texts))
                bounds = at_text.tolist()
                for i in range(len(texts)):
                    ids = every[bounds[i] : bounds[i + 1]].tobytes() + end
                    for k, (at, n) in enumerate(cut(len(ids) // 4, size)):
                        part = ids[4 * at : 4 * (at + n)]
                        row.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(n)
                        crc.append(zlib.crc32(part))
                        kept.append(part if with_ids else None)
                own = batch.column(0).slice(base, len(texts)).take(pa.array(row, pa.int64()))
                base += len(texts)
                cols = [own, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(kept, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"_id {id_type}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.mapInArrow(run, schema)


def reachable(room: int, sizes: list[int], left: dict[int, int]) -> list[int]:
    """For each i, the sums up to room that pieces of sizes[:i] can make, as the bits of an integer."""
    mask = (1 << (room + 1)) - 1
    out = [1]
    for v in sizes[: bisect_right(sizes, room)]:
        sums, n, k = out[-1], min(left[v], room // v), 1
        while n > 0:  # 1, 2, 4, ... pieces at once, and the rest
            sums |= sums << (v * min(k, n)) & mask
            n, k = n - k, 2 * k
        out.append(sums)
    return out


def exact(target: int, i: int, sizes: list[int], left: dict[int, int], reach: list[int]) -> Iterator[list[int]]:
    """All fillings from sizes[:i] whose sum is target, larger pieces first, without dead ends."""
    if not target:
        yield []
        return
    for j in range(min(i, bisect_right(sizes, target)), 0, -1):
        if not reach[j] >> target & 1:
            return
        v = sizes[j - 1]
        for k in range(min(left[v], target // v), 0, -1):
            if reach[j - 1] >> (target - k * v) & 1:
                for rest in exact(target - k * v, j - 1, sizes, left, reach):
                    yield [v] * k + rest


def filling(room: int, sizes: list[int], left: dict[int, int]) -> list[int]:
    """The filling of `room` with the least waste, larger pieces first; sizes ascends.

    The best-fit one if it wastes nothing, else by the sums that can be reached, so that no filling is missed.
    """
    free, best = room, []
    for v in reversed(sizes[: bisect_right(sizes, room)]):
        if v <= free:
            k = min(left[v], free // v)
            best += [v] * k
            free -= k * v
    if not free:
        return best
    reach = reachable(room, sizes, left)
    return next(exact(reach[-1].bit_length() - 1, len(reach) - 1, sizes, left, reach))


def dominated(inner: list[int], waste: int, sizes: list[int], left: dict[int, int]) -> bool:
    """Whether a piece still fits, or could stand for one or two smaller ones: then another filling is no worse."""
    def other(low: int, high: int) -> bool:
        at = bisect_right(sizes, high)
        return any(left[v] > inner.count(v) for v in sizes[bisect_right(sizes, low - 1) : at])

    if other(1, waste) or any(other(x + 1, x + waste) for x in set(inner)):
        return True
    pairs = {x + y for i, x in enumerate(inner) for y in inner[:i]}
    return any(other(x, x + waste) for x in pairs)


def fillings(room: int, sizes: list[int], left: dict[int, int], allowed: int) -> Iterator[list[int] | None]:
    """Undominated fillings by rising waste up to `allowed`; None for one that is dominated.

    What the first one was found by isn't kept, as most are never asked for a second.
    """
    first = filling(room, sizes, left)
    least = room - sum(first)
    if least > allowed:
        return
    yield first
    reach = reachable(room, sizes, left)
    for waste in range(least, min(allowed, room) + 1):
        if reach[-1] >> (room - waste) & 1:
            for inner in exact(room - waste, len(reach) - 1, sizes, left, reach):
                if inner != first:
                    yield None if dominated(inner, waste, sizes, left) else inner


def taken(left: dict[int, int], sizes: list[int], pattern: dict[int, int], times: int) -> None:
    """Take (or with negative times, give back) the pieces of some equal sequences."""
    for v, k in pattern.items():
        now = left.get(v, 0) - times * k
        if now and v not in left:
            insort(sizes, v)
        if now:
            left[v] = now
        else:
            del left[v]
            sizes.pop(bisect_right(sizes, v) - 1)


def best_fit_decreasing(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs by placing pieces, longest first, where the least room is left; equal sequences move together."""
    opened: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(room: int, bins: int, pattern: list[tuple[int, int]]) -> None:
        if bins:
            opened.setdefault(room, []).append((bins, pattern))

    for v, n in sorted(histogram.items(), reverse=True):
        for room in sorted(r for r in opened if r >= v):
            k = room // v
            for bins, pattern in opened.pop(room):
                whole = min(bins, n // k)
                put(room - k * v, whole, [*pattern, (v, k)])
                n, bins = n - whole * k, bins - whole
                if bins and n:
                    put(room - n * v, 1, [*pattern, (v, n)])
                    n, bins = 0, bins - 1
                put(room, bins, pattern)
            if not n:
                break
        whole, rest = divmod(n, size // v)
        put(size - size // v * v, whole, [(v, size // v)])
        if rest:
            put(size - rest * v, 1, [(v, rest)])
    return [run for room in sorted(opened) for run in opened[room]]


def greedy(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs by the filling of least waste around the largest length left, as often as the counts allow."""
    left, sizes, runs = dict(histogram), sorted(histogram), []
    while sizes:
        top = sizes[-1]
        taken(left, sizes, {top: 1}, 1)
        pattern = Counter([top, *filling(size - top, sizes, left)])
        taken(left, sizes, {top: 1}, -1)
        times = min(left[v] // k for v, k in pattern.items())
        runs.append((times, sorted(pattern.items(), reverse=True)))
        taken(left, sizes, pattern, times)
    return runs


def sequences_of(runs: list[tuple[int, list[tuple[int, int]]]]) -> int:
    return sum(times for times, _ in runs)


def least_sequences(histogram: dict[int, int], size: int) -> int:
    """A bound from below: sum of lengths, and pieces over a half with what can't stand beside them."""
    items = sorted(histogram.items())
    best = -(-sum(v * n for v, n in items) // size)
    for low in [v for v, _ in items if 2 * v <= size] or [0]:
        alone = sum(n for v, n in items if v > size - low)
        halves = [(v, n) for v, n in items if size < 2 * v <= 2 * (size - low)]
        room = sum(n * (size - v) for v, n in halves)
        small = sum(v * n for v, n in items if low <= v and 2 * v <= size)
        best = max(best, alone + sum(n for _, n in halves) + max(0, -(-(small - room) // size)))
    return best


def bin_completion(histogram: dict[int, int], size: int, nodes: int = SEARCH_NODES) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs (times, [(length, count)]) that use up the histogram.

    Branch and bound: incumbents are best-fit decreasing and the greedy runs. While more sequences than
    the bound stand, the search backtracks over undominated fillings and how often each is
    used, within the waste that an improvement allows; states seen before with no more waste
    are left. It is exact unless it stops after `nodes` fillings.
    """
    histogram = {v: n for v, n in histogram.items() if n > 0}
    if not histogram:
        return []
    best = min(greedy(histogram, size), best_fit_decreasing(histogram, size), key=sequences_of)
    bound, total = least_sequences(histogram, size), sum(v * n for v, n in histogram.items())
    left, sizes = dict(histogram), sorted(histogram)
    rnd = random.Random(0)
    mark = {v: rnd.getrandbits(128) for v in histogram}
    state = sum(mark[v] * n for v, n in left.items())
    seen: dict[int, int] = {}
    path: list[tuple[int, dict[int, int]]] = []
    wasted = [0]

    def allowed() -> int:
        return (sequences_of(best) - 1) * size - total - wasted[-1]

    def choices() -> Iterator[tuple[int, dict[int, int]] | None]:
        top = sizes[-1]
        taken(left, sizes, {top: 1}, 1)
        rest, rest_sizes = dict(left), sizes.copy()
        taken(left, sizes, {top: 1}, -1)
        for inner in fillings(size - top, rest_sizes, rest, allowed()):
            if inner is None:
                yield None
                continue
            pattern = Counter([top, *inner])
            most = min((rest[v] if v != top else rest.get(v, 0) + 1) // k for v, k in pattern.items())
            for times in range(most, 0, -1):
                yield times, pattern

    stack = [choices()]
    while stack and nodes > 0 and sequences_of(best) > bound:
        nodes -= 1
        move = next(stack[-1], 0) if allowed() >= 0 else 0
        if move is None:
            continue
        if move == 0:
            stack.pop()
            wasted.pop()
            if path:
                times, pattern = path.pop()
                taken(left, sizes, pattern, -times)
                state += times * sum(mark[v] * k for v, k in pattern.items())
            continue
        times, pattern = move
        waste = times * (size - sum(v * k for v, k in pattern.items()))
        then = state - times * sum(mark[v] * k for v, k in pattern.items())
        if waste > allowed() or seen.get(then, waste + wasted[-1] + 1) <= waste + wasted[-1]:
            continue
        taken(left, sizes, pattern, times)
        state = then
        seen[state] = waste + wasted[-1]
        path.append(move)
        wasted.append(wasted[-1] + waste)
        if sizes:
            stack.append(choices())
            continue
        best = [(t, sorted(p.items(), reverse=True)) for t, p in path]
        path.pop()
        wasted.pop()
        taken(left, sizes, pattern, -times)
        state += times * sum(mark[v] * k for v, k in pattern.items())
    return best


def intervals(runs: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """For each length, rows (first number, first sequence, pieces a sequence, first place), by first number."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    given: dict[int, int] = {}
    sequence = 0
    for times, pattern in runs:
        place = 0
        for v, k in pattern:
            rows.setdefault(v, []).append((given.get(v, 0), sequence, k, place))
            given[v] = given.get(v, 0) + times * k
            place += v * k
        sequence += times
    return {v: np.array(r, np.int64) for v, r in rows.items()}


def pack(
    docs: DataFrame, path: str, size: int = 2048, end_id: int = 0, with_ids: bool = True,
    id_col: str = "doc_id", text_col: str = "text", nodes: int = SEARCH_NODES,
) -> DataFrame:
    """Pack all documents into sequences of at most `size` tokens.

    Returns one row per piece: id_col, piece, start, length, ids_crc32, sequence_id, offset
    and, if asked for, ids (binary, little-endian unsigned 32-bit). A null or empty text is
    a document of the end id alone. Repeated rows are packed as often as they occur (their
    pieces may swap places). Other columns are dropped. An empty table gives no rows.

    Driver data: the histogram (`size` rows at most), the runs and the search. A greedy run
    ends when a length has fewer pieces left than a sequence takes of it, which for length v
    happens size/v times at most, so there are under size * (1 + ln size) of them; a found
    improvement has `nodes` runs at most. nodes is the number of fillings that the search visits: from some
    number on, which may be beyond any waiting, the packing is proved to be the least.
    """
    spark = docs.sparkSession
    pieces = stored(pieces_of(docs, path, size, end_id, with_ids, id_col, text_col))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast(intervals(bin_completion(histogram, size, nodes)))
    numbered = ranked(pieces, "length", ["_id", "piece"], sum(histogram.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            bounds = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, bounds):
                t, r = places.value[int(length[rows[0]])], rank[rows]
                t = t[np.searchsorted(t[:, 0], r, "right") - 1]
                r = r - t[:, 0]
                sequence[rows] = t[:, 1] + r // t[:, 2]
                offset[rows] = t[:, 3] + r % t[:, 2] * length[rows]
            batch = batch.drop_columns(["rank"])
            yield batch.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema.fields if f.name != "rank"]
    return numbered.mapInArrow(run, ", ".join([*fields, "sequence_id long, `offset` long"])).withColumnRenamed("_id", id_col)
