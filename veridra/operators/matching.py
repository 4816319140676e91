"""Approximate and rule-based matching of titles and names.

Candidates always come from an equi-join on a blocking key; the exact measure decides.
"""

from __future__ import annotations

import difflib
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..session import stored, tasks


def common_letters(x: str, y: str) -> int:
    """Letters of the longest common subsequence, a bit for each letter of x: no matching blocks hold more."""
    places: dict[str, int] = {}
    for i, c in enumerate(x):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(x)) - 1
    left = full
    for c in y:
        hit = left & places.get(c, 0)
        left = ((left + hit) | (left - hit)) & full
    return len(x) - left.bit_count()


def _ratio(x: str, y: str, least: float) -> float:
    """Ratio of matching blocks of two normalised titles; one inside the other (20 letters or more) is 1, one that can't reach `least` 0."""
    short, long = sorted((x, y), key=len)
    if len(short) >= INSIDE and short in long:
        return 1.0
    # from 200 letters on the matcher leaves frequent letters out and is the quicker one
    if least and len(y) < 200 and common_letters(x, y) * 2 < (least - 1e-6) * (len(x) + len(y)):
        return 0.0
    return difflib.SequenceMatcher(None, x, y).ratio()


def _scored(pairs: DataFrame, least: float) -> DataFrame:
    """(lt, rt, score) of the pairs (lt, rt) whose ratio is at least `least`, dealt anew as a pair costs far more than its bytes say.

    No column expression: Spark would move a filter of the score, and the measure with it, to before the pairs are dealt.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            scores = np.array([_ratio(x, y, least) for x, y in zip(pdf["lt"], pdf["rt"], strict=True)], float)
            yield pdf.assign(score=scores)[scores >= least - 1e-6]

    found = pairs.select("lt", "rt").repartition(tasks(pairs)).mapInPandas(run, "lt string, rt string, score double")
    return found.withColumn("score", F.round("score", 6)).where(F.col("score") >= least)


#: Letters of the shortest title that may count by standing inside another, buckets of letters and of pairs of letters.
INSIDE, LETTERS, PAIRS = 20, 32, 256
#: From so many letters of the right title on the ratio leaves its frequent letters out.
FREQUENT = 200
#: Most letters of titles that are compared by bits, pairs that are at a time, and letters of a block's titles together.
BITS, AT_ONCE, BLOCK_LETTERS = 1024, 8192, 1 << 24
#: Counters of runs of letters, and bits for each title that tell whether a run is looked for.
SLOTS, MARKS = 1 << 18, 32


def _sketched(titles: DataFrame) -> DataFrame:
    """(key, length, codes, rare) of titles (key, title): a byte for each letter, and by buckets how many letters are not frequent in a title of FREQUENT letters or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes, rare = [], []
            for title in pdf["title"]:
                points = np.frombuffer(title.encode("utf-32-le", "surrogatepass"), np.uint32)
                codes.append((points % 256).astype(np.uint8).tobytes())
                if len(points) < FREQUENT:
                    rare.append(b"")
                    continue
                letters, often = np.unique(points, return_counts=True)
                seldom = often <= len(points) // 100 + 1
                rare.append(np.bincount(letters[seldom] % LETTERS, often[seldom], LETTERS).astype(np.int32).tobytes())
            yield pd.DataFrame({"key": pdf["key"], "length": pdf["title"].str.len(), "codes": codes, "rare": rare})

    return titles.select("key", "title").repartition(tasks(titles)).mapInPandas(run, "key binary, length int, codes binary, rare binary")


class _Side:
    """Titles of a block, shortest first: all their letters in a row, by buckets, and counts of letters and of pairs of letters (255 at most)."""

    def __init__(self, rows: pd.DataFrame) -> None:
        rows = rows.sort_values("length", kind="stable")
        self.keys, self.length = rows["key"].to_numpy(), rows["length"].to_numpy(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        codes = np.frombuffer(b"".join(rows["codes"]), np.uint8)
        self.codes = codes % LETTERS
        self.letters, self.pairs = np.empty((len(rows), LETTERS), np.uint8), np.empty((len(rows), PAIRS), np.uint8)
        self.rare = np.zeros((len(rows), LETTERS), np.int32)
        for i in np.flatnonzero(self.length >= FREQUENT):
            self.rare[i] = np.frombuffer(rows["rare"].iat[i], np.int32)
        at = 0
        while at < len(rows):
            end = max(at + 1, min(at + 4096, int(np.searchsorted(self.start, self.start[at] + (1 << 20), "right")) - 1))
            part = codes[self.start[at] : self.start[end]].astype(np.int64)
            row = np.repeat(np.arange(end - at), self.length[at:end])
            self.letters[at:end] = np.minimum(self._counts(row, part % LETTERS, end - at, LETTERS), 255)
            inner = row[:-1] == row[1:]
            self.pairs[at:end] = np.minimum(self._counts(row[:-1][inner], ((part[:-1] * 37 + part[1:]) % PAIRS)[inner], end - at, PAIRS), 255)
            at = end

    @staticmethod
    def _counts(row: np.ndarray, bucket: np.ndarray, rows: int, buckets: int) -> np.ndarray:
        return np.bincount(row * buckets + bucket, minlength=rows * buckets).reshape(rows, buckets)

    def all_letters(self, rows: np.ndarray) -> np.ndarray:
        """Counts of letters by buckets, of any size."""
        which, back = np.unique(rows, return_inverse=True)
        return np.stack([np.bincount(self.codes[self.start[i] : self.start[i + 1]], minlength=LETTERS) for i in which])[back]


def _shared_letters(a: _Side, b: _Side, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each pair of titles (rows u of a, v of b) the letters of a longest common subsequence of their buckets: common_letters for many pairs at a time."""
    order = np.argsort(-b.length[v], kind="stable")
    u, v = u[order], v[order]
    which, own = np.unique(u, return_inverse=True)
    words, base = -(-int(a.length[which].max()) // 64), own * LETTERS
    places = np.zeros((words, len(which) * LETTERS), np.uint64)
    bit = np.arange(int(a.length[which].max()))
    for i, row in enumerate(which):
        letters = a.codes[a.start[row] : a.start[row + 1]]
        np.bitwise_or.at(places, (bit[: len(letters)] >> 6, i * LETTERS + letters.astype(np.int64)), np.uint64(1) << (bit[: len(letters)] & 63).astype(np.uint64))
    left = np.full((words, len(u)), ~np.uint64(0))
    at, length = b.start[v].copy(), b.length[v]
    # the longest come first, so those that are not over are the first ones
    going = len(u) - np.searchsorted(length[::-1], np.arange(int(length[0])), "right")
    for n in going:
        places_of = base[:n] + b.codes.take(at[:n])
        at[:n] += 1
        carry = None
        for w in range(words):
            own_left = left[w, :n]
            hit = places[w].take(places_of)
            hit &= own_left
            total = own_left + hit
            over = total < hit if w + 1 < words else None
            if carry is not None:
                total += carry
                if over is not None:
                    over |= total < carry
            own_left ^= hit
            own_left |= total
            carry = over
    out = np.empty(len(u), np.int64)
    out[order] = np.bitwise_count(~left).sum(axis=0, dtype=np.int64)
    return out


def _near(least: float, cells: int = 1 << 18) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Pairs of two blocks that may reach a ratio, by bounds of what they can share; `cells` pairs at a time."""

    def alike(a: _Side, b: _Side, at: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of pairs of titles at to end of a whose counts are near enough."""
        low, high = (a.length[i] * f for i, f in ((at, least / (2 - least)), (end - 1, (2 - least) / least)))
        lo, hi = int(np.searchsorted(b.length, low - 1)), int(np.searchsorted(b.length, high + 1, "right"))
        if lo == hi:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        la, lb = (x.astype(np.float32) for x in (a.length[at:end], b.length[lo:hi]))
        spare = (1 - least) * (la[:, None] + lb[None]) + 0.01
        # letters that are not shared, of both titles together; 31 of a bucket are told apart, so that eight buckets make a byte
        apart, some, diff = np.zeros(spare.shape, np.uint16), *(np.empty(spare.shape, np.int8) for _ in range(2))
        part, own = np.minimum(a.letters[at:end], 31).view(np.int8), b.letters31[:, lo:hi]
        for k in range(LETTERS):
            to = diff if k % 8 else some
            np.subtract(part[:, k, None], own[k][None], out=to)
            np.abs(to, out=to)
            if k % 8:
                np.add(some.view(np.uint8), diff.view(np.uint8), out=some.view(np.uint8))
            if k % 8 == 7:
                apart += some.view(np.uint8)
        near = apart <= np.minimum(spare, 65535).astype(np.uint16)
        near &= np.abs(la[:, None] - lb[None]) <= spare
        i, j = np.divmod(np.flatnonzero(near), hi - lo)
        kept = []
        for cut in range(0, len(i), 1 << 12):
            u, v = i[cut : cut + (1 << 12)] + at, j[cut : cut + (1 << 12)] + lo
            x, y = a.pairs[u], b.pairs[v]
            lost = (np.maximum(x, y) - np.minimum(x, y)).sum(axis=1, dtype=np.int32)
            most = spare[u - at, v - lo]
            keep = lost <= 3 * most
            # each run of matched letters but the first holds a letter that is not frequent
            long = np.flatnonzero(keep & (b.length[v] >= FREQUENT))
            if len(long):
                seeds = np.minimum(a.all_letters(u[long]), b.rare[v[long]]).sum(axis=1)
                keep[long] = lost[long] <= most[long] + 2 * seeds
            kept.append((u[keep], v[keep]))
        return tuple(np.concatenate(x) for x in zip(*kept, strict=True)) if kept else (i, j)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        if len(left) and len(right):
            a, b = _Side(left), _Side(right)
            b.letters31 = np.ascontiguousarray(np.minimum(b.letters, 31).T).view(np.int8)
            held: list[tuple[np.ndarray, np.ndarray]] = []

            def compared() -> None:
                """The pairs that are held, by their common subsequences; then none are."""
                u, v = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                # shorter ones of like length are compared together; u runs by length
                by_bits = (a.length[u] <= BITS) & (b.length[v] <= BITS)
                found.append((u[~by_bits], v[~by_bits]))
                u, v = u[by_bits], v[by_bits]
                for cut in range(0, len(u), AT_ONCE):
                    x, y = u[cut : cut + AT_ONCE], v[cut : cut + AT_ONCE]
                    keep = _shared_letters(a, b, x, y) * 2 >= least * (a.length[x] + b.length[y]) - 1e-6
                    found.append((x[keep], y[keep]))

            step = max(1, cells // len(b.length))
            for at in range(0, len(a.length), step):
                held.append(alike(a, b, at, min(at + step, len(a.length))))
                if sum(len(x) for x, _ in held) >= 1 << 18:
                    compared()
            if held:
                compared()
            i, j = (np.concatenate(x) for x in zip(*found, strict=True))
            return pd.DataFrame({"l": a.keys[i], "r": b.keys[j]})
        return pd.DataFrame({"l": [], "r": []})

    return run


def _near_titles(left: DataFrame, right: DataFrame, least: float, block: int) -> DataFrame:
    """(l, r) of keys of titles that may have a ratio of at least `least`.

    Titles of one class of length are dealt into blocks, and every two blocks of near classes meet once, in
    one task, where all bounds are applied: the cost is pairs of titles of like length, a few nanoseconds
    each, memory is bounded, and no pair is shuffled that the bounds rule out.
    Matched letters M of |a| + |b| = T leave k = T - 2M <= (1 - q)T letters, which part them into k + 1 runs
    at most: so counts of letters differ by k at most, and counts of pairs of letters by 3k at most.
    Where frequent letters of the right title begin no run, s letters that are not frequent and in both allow
    s + 1 runs at most, and pairs differ by k + 2s.
    """
    base = math.log((2 - least) / least) * 1.0001
    kind = F.floor(F.log(F.col("length")) / base).cast("int")
    a, b = (stored(_sketched(x).withColumn("kind", kind)) for x in (left, right))
    counts = [x.groupBy("kind").agg(F.count("*").alias("n"), F.sum("length").alias("letters")).collect() for x in (a, b)]
    sizes = [{r["kind"]: max(-(-r["n"] // block), -(-r["letters"] // BLOCK_LETTERS)) for r in x} for x in counts]
    spark, n = left.sparkSession, tasks(left)

    def dealt(df: DataFrame, own: dict[int, int], other: dict[int, int], first: bool) -> DataFrame:
        """Each row once for every block of the other side that its own block meets."""
        met = [(k, s, g, o) for k, m in own.items() for s in range(m) for g in (k - 1, k, k + 1) for o in range(other.get(g, 0))]
        meets = spark.createDataFrame([(k, s, f"{k}.{s}-{g}.{o}" if first else f"{g}.{o}-{k}.{s}") for k, s, g, o in met], "kind int, share int, meet string")
        shares = F.create_map(*[F.lit(x) for pair in own.items() for x in pair])[F.col("kind")]
        rows = df.withColumn("share", F.pmod(F.xxhash64("key"), shares).cast("int"))
        return rows.join(F.broadcast(meets), ["kind", "share"]).select("meet", "key", "length", "codes", "rare").repartition(n, "meet")

    if not sizes[0] or not sizes[1]:
        return spark.createDataFrame([], "l binary, r binary")
    both = dealt(a, *sizes, True).groupBy("meet").cogroup(dealt(b, *sizes[::-1], False).groupBy("meet"))
    return both.applyInPandas(_near(least), "l binary, r binary")


def _runs(titles: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all runs of INSIDE letters, and the places of their titles, for some titles at a time."""
    ends = titles.str.len().cumsum().to_numpy()
    at = 0
    while at < len(titles):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 18), "right")))
        codes = np.frombuffer("".join(titles.iloc[at:end]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        row = np.repeat(np.arange(at, end), titles.iloc[at:end].str.len())
        n = len(codes) - INSIDE + 1
        if n > 0:
            hashes = np.uint64(0)
            for i in range(INSIDE):
                hashes = (hashes ^ codes[i : i + n]) * np.uint64(0xD6E8FEB86659FD93)
                hashes ^= hashes >> np.uint64(32)
            own = row[:n] == row[INSIDE - 1 :]
            yield row[:n][own], hashes.view(np.int64)[own]
        at = end


def _windows(titles: DataFrame, marks: np.ndarray | None = None) -> DataFrame:
    """(key, window): hashes of runs of INSIDE letters of a title, those that are marked if there are marks, in time that grows with its length."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = pdf["key"].to_numpy()
            for row, window in _runs(pdf["title"]):
                if marks is not None:
                    bit = window & (len(marks) * 64 - 1)
                    keep = (marks[bit >> 6].view(np.uint64) >> (bit & 63).astype(np.uint64)) & np.uint64(1) > 0
                    row, window = row[keep], window[keep]
                yield pd.DataFrame({"row": row, "window": window}).drop_duplicates().assign(key=lambda x: keys[x["row"]])[["key", "window"]]

    return titles.where(F.length("title") >= INSIDE).select("key", "title").repartition(tasks(titles)).mapInPandas(run, "key binary, window long")


def _often(titles: DataFrame) -> np.ndarray:
    """How often runs of letters occur in titles, by SLOTS counters of hashes: tasks count (255 at most), and their counts are added."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(SLOTS, np.int64)
        for pdf in batches:
            for _, window in _runs(pdf["title"]):
                counts += np.bincount(window & (SLOTS - 1), minlength=SLOTS)
        parts = np.minimum(counts, 255).astype(np.uint8).reshape(16, -1)
        yield pd.DataFrame({"part": range(16), "counts": [p.tobytes() for p in parts]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.uint8).astype(np.int32) for c in pdf["counts"])
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "counts": [total.tobytes()]})

    long = titles.where(F.length("title") >= INSIDE).select("title").repartition(tasks(titles))
    kind = "part int, counts binary"
    rows = sorted(long.mapInPandas(count, kind).groupBy("part").applyInPandas(add, kind).collect(), key=lambda r: r["part"])
    return np.frombuffer(b"".join(bytes(r["counts"]) for r in rows), np.int32)


def _rarest(titles: DataFrame, often: np.ndarray) -> DataFrame:
    """(key, window): the run of letters of each title whose counter is least."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = pdf["key"].to_numpy()
            for row, window in _runs(pdf["title"]):
                order = np.lexsort((window, often[window & (SLOTS - 1)], row))
                first = order[np.unique(row[order], return_index=True)[1]]
                yield pd.DataFrame({"key": keys[row[first]], "window": window[first]})

    return titles.where(F.length("title") >= INSIDE).select("key", "title").repartition(tasks(titles)).mapInPandas(run, "key binary, window long")


def _inside(short: DataFrame, long: DataFrame, rows: int) -> DataFrame:
    """(short, long) of keys of titles (key, title) among which are all where a title stands inside the other.

    Such two share the run of letters that is rarest, by counters, in `long`; of the runs of `long` only those
    are shuffled that some short title looks for, by a table of marks.
    """
    rare = stored(_rarest(short, _often(long)))
    size = 1 << max(12, (rows * MARKS - 1).bit_length())
    place = F.col("window").bitwiseAND(F.lit(size - 1))
    bits = F.expr("shiftleft(1L, cast(window & 63 as int))")
    found = rare.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(bits).alias("bits")).toArrow()
    marks = np.zeros(size // 64, np.int64)
    marks[found["at"].to_numpy()] = found["bits"].to_numpy()
    held = _windows(long, marks).select(F.col("key").alias("long"), "window")
    return rare.withColumnRenamed("key", "short").join(held, "window").select("short", "long")


def title_candidates(left: DataFrame, right: DataFrame, least: float, block: int | None = None) -> DataFrame:
    """Pairs (l, r) of keys of titles (key, title) among which are all with a ratio of at least `least`, or with one inside the other."""
    rows = max(left.count(), right.count())
    near = _near_titles(left, right, least - 1e-6, block or min(max(rows // 24, 1024), 1 << 15))
    inner = _inside(left, right, rows).select(F.col("short").alias("l"), F.col("long").alias("r"))
    outer = _inside(right, left, rows).select(F.col("long").alias("l"), F.col("short").alias("r"))
    return near.union(inner).union(outer).distinct()


def title_scores(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(lt, rt, score) of all pairs of distinct titles with a ratio of at least `least`; no pair is lost, and a title that repeats is compared once.

    Until the exact measure a digest stands for a title, so that long titles do not travel with all their parts.
    """
    once = lambda df: stored(df.where(F.length("title") > 0).select("title").distinct().withColumn("key", F.unhex(F.md5("title"))))
    a, b = once(left), once(right)
    pairs = stored(title_candidates(a, b, least))
    full = pairs.join(a.select(F.col("key").alias("l"), F.col("title").alias("lt")), "l").join(b.select(F.col("key").alias("r"), F.col("title").alias("rt")), "r")
    # letters that can be shared at all: most candidates end here, in the JVM
    able = F.least(F.length("lt"), F.length("rt")) * 2 >= F.lit(least) * (F.length("lt") + F.length("rt"))
    inside = (F.least(F.length("lt"), F.length("rt")) >= INSIDE) & (F.contains("lt", F.col("rt")) | F.contains("rt", F.col("lt")))
    return _scored(full.where(able | inside), least)


def fuzzy_title_pairs(left: DataFrame, right: DataFrame, least: float = 0.9) -> DataFrame:
    """left and right rows of all pairs whose titles have a ratio of at least `least`, with `score`; no pair is lost.

    left: l, title and more; right: r, title and more (normalised titles; no other name in common).
    """
    scores = title_scores(left, right, least)
    return scores.join(left.withColumnRenamed("title", "lt"), "lt").join(right.withColumnRenamed("title", "rt"), "rt")


def fuzzy_title_join(left: DataFrame, right: DataFrame, least: float = 0.9) -> DataFrame:
    """(l, r, score): the best right title of each left one, the smallest r among equals. Of right rows with one title the smallest stands for all."""
    first = right.groupBy(F.col("title").alias("rt")).agg(F.min("r").alias("r"))
    scored = title_scores(left, right, least).join(first, "rt")
    best = scored.groupBy("lt").agg(F.min_by(F.struct("r", "score"), F.struct(-F.col("score"), "r")).alias("b"))
    return left.join(best, F.col("title") == F.col("lt")).select("l", "b.r", "b.score")


def verified_titles(segments: DataFrame, records: DataFrame, least: float = 0.85) -> DataFrame:
    """(l, r, score) of cited segments and records: titles alike, years within one, no erratum.

    segments: l, title, cited_year; records: r, title, record_year.
    """
    plain = ~F.col("title").rlike(r"^(?:erratum|corrigendum|correction|author correction)\b")
    near = fuzzy_title_pairs(segments, records.where(plain), least).where(year_near(F.col("cited_year"), F.col("record_year")))
    return near.select("l", "r", "score")


def year_near(a: Column, b: Column) -> Column:
    """Years that differ by one at most; an unknown year never excludes."""
    return F.coalesce(F.abs(a - b) <= 1, F.lit(True))


def name_method(first: Column, author_first: Column, author_initials: Column, middle: Column | None = None) -> Column:
    """`forename` if first names agree or one begins the other, `initials` if only initials do. Lower-case letters.

    Where both sides have a middle initial (the second of the author's initials), the two must agree.
    """
    full = (F.length(first) > 1) & (F.length(author_first) > 1)
    agree = first.startswith(author_first) | author_first.startswith(first)
    initials = F.coalesce(F.nullif(author_initials, F.lit("")), author_first)
    initial = F.substring(initials, 1, 1) == F.substring(first, 1, 1)
    method = F.when(full & agree, "forename").when(~full & initial, "initials")
    if middle is None:
        return method
    second = F.nullif(F.substring(F.coalesce(author_initials, F.lit("")), 2, 1), F.lit(""))
    return F.when(F.coalesce(F.substring(F.nullif(middle, F.lit("")), 1, 1) == second, F.lit(True)), method)


def name_join(people: DataFrame, authors: DataFrame) -> DataFrame:
    """(l, r, method) of people and authors with one last name whose other names are compatible.

    people: l, last, first, middle; authors: r, last, forename, initials (all lower-case).
    """
    both = people.join(authors, "last")
    method = name_method(F.col("first"), F.col("forename"), F.col("initials"), F.col("middle"))
    return both.select("l", "r", method.alias("method")).where("method IS NOT NULL")


# ---- text parts


@F.pandas_udf(ArrayType(StringType()))
def title_segments(citations: pd.Series) -> pd.Series:
    """Parts of a citation that may be its title: quoted text, else sentences; longest first, four at most."""
    def parts(text: str) -> list[str]:
        quoted = re.findall(r"[\"“]([^\"”]{10,})[\"”]", text)
        found = quoted or [s.strip() for s in re.split(r"[.;:]\s", text)]
        return sorted(dict.fromkeys(p for p in found if len(p) >= 10), key=lambda p: (-len(p), p))[:4]

    return citations.map(parts, na_action="ignore")


def locators(citation: Column) -> Column:
    """All volume:page candidates, overlapping ones too: the pattern looks ahead and takes nothing."""
    pattern = F.lit(r"(?=\b(\d{1,4})\D{1,12}(\d{1,6})\b)")
    return F.zip_with(F.regexp_extract_all(citation, pattern, F.lit(1)), F.regexp_extract_all(citation, pattern, F.lit(2)), lambda v, p: F.concat_ws(":", v, p))


def federal_statement(text: Column, letters: int = 320) -> Column:
    """The sentence that names government support, cut to a length."""
    s = F.regexp_extract(text, r"(?i)([^.]*\b(?:government support|federally sponsored|awarded by)\b[^.]*\.?)", 1)
    return F.substring(F.nullif(F.trim(s), F.lit("")), 1, letters)
