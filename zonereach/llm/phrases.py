"""Phrase collocations from a three-way quicksort of suffix pointers.

Every word position begins a suffix of at most ``max_words`` words that ends with its piece of text. Equal suffixes of a
run of texts are one pointer with a weight. Pointers are routed by their leading words, and each route sorts its pointers
by multikey three-way quicksort: the pointers equal to the pivot at a depth share one prefix, so their weight is the count
of that phrase, and they are sorted on by the next word. A partition that weighs less than the least count holds no
frequent phrase and is abandoned at once.

A leading word that fills a route by itself is routed by two words, a pair that does so by three and so on; the counts of
such short prefixes are sums over routes. Which prefixes these are is counted first, over all texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import Scratch
from .text_arrays import LOWER, mixed

SPLIT = np.zeros(256, bool)
SPLIT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True
# Text of a run, whose pointers a worker combines, and text whose pointers make a route.
RUN_BYTES = 6_000_000
ROUTE_BYTES = 12_000_000
# Prefixes that are routed by more words are named to all tasks; there are at most four a route.
MOST_ROUTES = 1 << 18
RANK_BUCKETS = 256

SUFFIXES = "route int, lang string, words array<binary>, codes binary, levels binary, weights binary"
PREFIXES = "lang string, first binary, second binary, n long"
COUNTS = "lang string, phrase string, words int, f long"


def cut_text(text: bytes, most: int, depth: int) -> list[tuple[bytes, int]]:
    """A long text in segments of about ``most`` bytes, each with the number of its bytes where suffixes begin.

    A segment ends behind a sign that ends a piece. Where a piece is longer than a segment, the segment ends at a blank
    and has the next words too, in which no suffix of its own begins.
    """
    out, at = [], 0
    while len(text) - at > most:
        window = np.frombuffer(text, np.uint8, most, at)
        signs = np.flatnonzero(SPLIT[window])
        if len(signs):
            end = at + int(signs[-1]) + 1
            out.append((text[at:end], end - at))
            at = end
            continue
        rest = np.frombuffer(text, np.uint8, offset=at)
        blank = BLANK[rest[:most]]
        edges = np.flatnonzero(blank) if blank.any() else np.flatnonzero((BLANK | SPLIT)[rest])[:1]
        if not len(edges):
            break
        end = at + int(edges[-1]) + 1
        # The words behind the edge, up to the sign that ends the piece.
        reach, words = end, 0
        while reach < len(text) and words < depth - 1 and not SPLIT[text[reach]]:
            if not BLANK[text[reach]] and (reach + 1 == len(text) or BLANK[text[reach + 1]] or SPLIT[text[reach + 1]]):
                words += 1
            reach += 1
        out.append((text[at:reach], end - at))
        at = end
    out.append((text[at:], len(text) - at))
    return out


class Suffixes:
    """The distinct suffixes of a run of texts: language, a row of word codes (0: none) and a weight each.

    ``words`` has the words of the codes 1, 2, ...; codes are exact, as words are told apart by their bytes.
    """

    def __init__(self, texts: list[tuple[bytes, int]], langs: np.ndarray, depth: int):
        sizes = np.array([len(t) for t, _ in texts], np.int64)
        data = LOWER[np.frombuffer(b"\n".join([*(t for t, _ in texts), b""]), np.uint8)]
        ends = np.cumsum(sizes + 1)
        split = SPLIT[data]
        inside = np.append(~(split | BLANK[data]), False)
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        starts, stops = edge[::2], edge[1::2]
        piece = np.searchsorted(np.flatnonzero(split), starts)
        self.words, codes = self._coded(data[inside[:-1]], np.append(0, np.cumsum(stops - starts)))
        text = np.searchsorted(ends, starts, side="right")
        matrix = np.zeros((len(codes), depth), np.int32)
        matrix[:, 0] = codes
        for k in range(1, depth):
            same = piece[k:] == piece[:-k] if k < len(piece) else np.empty(0, bool)
            matrix[: len(same), k] = np.where(same, codes[k:], 0)
        limits = (ends - sizes - 1) + np.array([n for _, n in texts], np.int64)
        own = starts < limits[text]
        self.matrix, self.lang, self.weights = _combined(matrix[own], langs[text[own]], len(self.words))

    @staticmethod
    def _coded(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        )
        coded = words.dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1


def _combined(matrix: np.ndarray, lang: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal rows of one language once, with their number."""
    if not len(matrix):
        return matrix, lang, np.empty(0, np.int64)
    langs = int(lang.max()) + 1
    if langs * (words + 1) ** matrix.shape[1] < 1 << 63:
        key = lang.astype(np.int64)
        for column in matrix.T:
            key = key * (words + 1) + column
        order = np.argsort(key)
        key = key[order]
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    else:
        order = np.lexsort([*matrix.T[::-1], lang])
        rows, own = matrix[order], lang[order]
        change = (rows[1:] != rows[:-1]).any(axis=1) | (own[1:] != own[:-1])
        head = np.flatnonzero(np.append(True, change))
    return matrix[order[head]], lang[order[head]], np.diff(np.append(head, len(order)))


def _runs(batches, depth: int):
    """Suffixes and languages of runs of about RUN_BYTES; a longer text is cut."""
    texts, langs, names, size = [], [], {}, 0

    def done():
        return Suffixes(texts, np.array(langs, np.int32), depth), list(names)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
            raw = text.as_buffer()
            if raw is None or not len(raw):
                continue
            for segment in cut_text(raw.to_pybytes(), RUN_BYTES, depth) if len(raw) > RUN_BYTES else [(raw.to_pybytes(), len(raw))]:
                if size and size + len(segment[0]) > RUN_BYTES:
                    yield done()
                    texts, langs, names, size = [], [], {}, 0
                texts.append(segment)
                langs.append(names.setdefault(lang, len(names)))
                size += len(segment[0]) + 1
    if texts:
        yield done()


def _heavy(routes: int, depth: int):
    """Of each run: its words by language, and the prefixes with at least half of a route's share of it."""

    def run(batches):
        for s, langs in _runs(batches, depth):
            least = max(1, -(-int(s.weights.sum()) // (2 * routes)))
            words = pa.concat_arrays([pa.nulls(1, s.words.type), s.words])
            for k in range(min(depth, 3)):
                # Prefixes of k words: rows of one prefix follow one another, as rows are in order.
                rows, lang = s.matrix[:, :k], s.lang
                head = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1) | (lang[1:] != lang[:-1]))) if len(lang) else []
                if not len(head):
                    continue
                n = np.add.reduceat(s.weights, head)
                keep = np.flatnonzero((n >= least) & (rows[head] > 0).all(axis=1)) if k else np.arange(len(n))
                at = head[keep]
                column = lambda i: words.take(pa.array(rows[at, i])) if i < k else pa.nulls(len(at), words.type)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[i] for i in lang[at]], pa.string()), *(column(i).cast(pa.binary()) for i in (0, 1)), pa.array(n[keep], pa.int64())],
                    ["lang", "first", "second", "n"],
                )

    return run


class Routes:
    """Where a suffix goes: by its first word, or by more words where the prefix fills a route."""

    def __init__(self, count: int, heavy: list[tuple[str, bytes, bytes | None]]):
        self.count = count
        words = sorted({w for _, *own in heavy for w in own if w is not None})
        langs = sorted({lang for lang, *_ in heavy})
        self.words, self.langs = words, {lang: i for i, lang in enumerate(langs)}
        place = {w: i + 1 for i, w in enumerate(words)}
        self.ones = np.array(sorted(self._key(self.langs[a], place[b], 0) for a, b, c in heavy if c is None), np.int64)
        self.twos = np.array(sorted(self._key(self.langs[a], place[b], place[c]) for a, b, c in heavy if c is not None), np.int64)

    def _key(self, lang, one, two):
        return (lang * (len(self.words) + 1) + one) * (len(self.words) + 1) + two

    def __call__(self, s: Suffixes, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Route of each suffix, and by how many words it is routed."""
        hashes = np.array([0, *(xxhash.xxh64_intdigest(w, 1) for w in s.words.to_pylist())], np.uint64)
        own = np.array([xxhash.xxh64_intdigest(x.encode(), 2) for x in names], np.uint64)
        h = mixed(own[s.lang] ^ hashes[s.matrix[:, 0]])
        level = np.ones(len(h), np.int8)
        depth = s.matrix.shape[1]
        if self.words and depth > 1:
            found = pc.index_in(s.words.cast(pa.binary()), value_set=pa.array(self.words, pa.binary()))
            place = np.append(0, pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            lang = np.array([self.langs.get(x, -1) for x in names], np.int64)[s.lang]
            one, two = place[s.matrix[:, 0]], place[s.matrix[:, 1]]
            first = (lang >= 0) & (one > 0) & np.isin(self._key(lang, one, 0), self.ones)
            second = first & (two > 0) & np.isin(self._key(lang, one, two), self.twos)
            h = np.where(first, mixed(h * np.uint64(3) + hashes[s.matrix[:, 1]]), h)
            level += first
            for k in range(2, depth):
                h = np.where(second, mixed(h * np.uint64(3) + hashes[s.matrix[:, k]]), h)
            level[second] = depth
        return (h % np.uint64(self.count)).astype(np.int32), level


def _route(routes: Routes, depth: int):
    def run(batches):
        for s, names in _runs(batches, depth):
            route, level = routes(s, names)
            order = np.lexsort((s.lang, route))
            route, lang = route[order], s.lang[order]
            heads = np.flatnonzero(np.append(True, (route[1:] != route[:-1]) | (lang[1:] != lang[:-1]))) if len(order) else np.empty(0, int)
            words = pa.concat_arrays([pa.array([b""], s.words.type), s.words])
            out = {c.split()[0]: [] for c in SUFFIXES.split(", ")}
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(order)]):
                own = order[a:b]
                used, codes = np.unique(np.append(0, s.matrix[own]), return_inverse=True)
                out["route"].append(int(route[a]))
                out["lang"].append(names[lang[a]])
                out["words"].append(words.take(pa.array(used[1:])).cast(pa.binary()))
                out["codes"].append(codes[1:].astype("<i4").tobytes())
                out["levels"].append(level[own].tobytes())
                out["weights"].append(s.weights[own].astype("<i8").tobytes())
            if not heads.size:
                continue
            sizes = np.append(0, np.cumsum([len(w) for w in out["words"]]))
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.concat_arrays(out["words"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["route"], pa.int32()), pa.array(out["lang"], pa.string()), lists]
                + [pa.array(out[c], pa.binary()) for c in ("codes", "levels", "weights")],
                list(out),
            )

    return run


def quicksort(codes: np.ndarray, weights: np.ndarray, least: int):
    """Multikey three-way quicksort of suffix pointers; yields (pointers, depth, weights), one pointer a frequent prefix.

    All open partitions take a step at a time: each has the median of three pointers as its pivot and falls into the
    pointers below, equal to and above it at its depth. Equal ones go on to the next word; a partition that weighs less
    than ``least`` is abandoned, as is one whose suffixes have ended.
    """
    n, depth = codes.shape
    flat = codes.ravel()
    pointer = np.arange(n)
    begins = np.zeros(1 if n and weights.sum() >= least else 0, np.int64)
    at = np.zeros(len(begins), np.int64)
    while len(begins):
        lengths = np.diff(np.append(begins, len(pointer)))
        part = np.repeat(np.arange(len(begins)), lengths)
        key = flat[pointer * depth + at[part]]
        a, b, c = key[begins], key[begins + lengths // 2], key[begins + lengths - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        mine = pivot[part]
        side = part * 3 + 1 + (key > mine) - (key < mine)
        weight = np.bincount(side, weights[pointer], 3 * len(begins)).astype(np.int64)
        level, which = np.repeat(at, 3), np.tile(np.arange(3), len(at))
        equal, ended = which == 1, np.repeat(pivot == 0, 3)
        level += equal
        alive = (weight >= least) & ~(equal & ended)
        # Any pointer of an equal partition stands for its prefix.
        new = np.flatnonzero(equal & alive)
        some = np.empty(3 * len(begins), np.int64)
        some[side] = pointer
        yield some[new], level[new], weight[new]
        alive &= ~(equal & (level == depth))
        on = alive[side]
        packed = np.sort((side[on] << 32) | pointer[on])
        pointer, side = packed & 0xFFFFFFFF, packed >> 32
        begins = np.flatnonzero(np.append(True, side[1:] != side[:-1])) if len(side) else np.empty(0, np.int64)
        at = level[side[begins]]


def _mine(least: int, depth: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lists = table.column("words").combine_chunks()
        lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
        coded = lists.flatten().cast(pa.large_binary()).dictionary_encode()
        global_codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
        edges = np.append(0, np.cumsum(np.diff(lists.offsets.to_numpy())))
        parts = []
        for i, raw in enumerate(table.column("codes")):
            local = np.append(np.int32(0), global_codes[edges[i] : edges[i + 1]])
            parts.append(local[np.frombuffer(raw.as_buffer(), "<i4").reshape(-1, depth)])
        codes = np.concatenate(parts)
        del parts
        joined = lambda c, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(c)])
        weights, levels = joined("weights", "<i8"), joined("levels", np.int8)
        found = [(p, d, w) for p, d, w in quicksort(codes, weights, least) if len(p)]
        pointer, length, weight = (np.concatenate(x) if found else np.empty(0, np.int64) for x in (list(zip(*found)) or [[], [], []]))
        # Prefixes shorter than what routed them are in other routes too: all of them, whatever they weigh here.
        whole = length >= levels[pointer]
        pointer, length, weight = [pointer[whole]], [length[whole]], [weight[whole]]
        for k in range(1, int(levels.max(initial=1))):
            own = np.flatnonzero((levels > k) & (codes[:, k - 1] > 0))
            rows, _, n = _weighed(codes[own, :k], weights[own])
            pointer.append(own[rows])
            length.append(np.full(len(rows), k))
            weight.append(n)
        pointer, length, weight = (np.concatenate(x) for x in (pointer, length, weight))
        words = pa.concat_arrays([pa.array([b""], pa.large_binary()), coded.dictionary])
        phrases, counts, sizes = [], [], []
        for k in range(1, depth + 1):
            own = np.flatnonzero(length == k)
            if len(own):
                columns = [words.take(pa.array(codes[pointer[own], i])) for i in range(k)]
                phrases.append(pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string()).cast(pa.string()))
                counts.append(weight[own])
                sizes.append(np.full(len(own), k, np.int32))
        total = sum(len(p) for p in phrases)
        return pa.table(
            {
                "lang": pa.array([key[1].as_py()] * total, pa.string()),
                "phrase": pa.chunked_array(phrases, pa.string()),
                "words": pa.array(np.concatenate(sizes) if sizes else [], pa.int32()),
                "f": pa.array(np.concatenate(counts) if counts else [], pa.int64()),
            }
        )

    return run


def _weighed(rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row number of each distinct row, and the weight of all equal ones."""
    if not len(rows):
        return np.empty(0, np.int64), rows, np.empty(0, np.int64)
    order = np.lexsort(rows.T[::-1])
    own = rows[order]
    head = np.flatnonzero(np.append(True, (own[1:] != own[:-1]).any(axis=1)))
    return order[head], own[head], np.add.reduceat(weights[order], head)


def phrase_counts(
    docs: DataFrame,
    scratch: Scratch,
    max_words: int = 3,
    min_count: int = 10,
    lang: str = "lang",
    text: str = "text",
    other: str = "und",
    route_bytes: int = ROUTE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Counts of all phrases of up to ``max_words`` words with at least ``min_count`` occurrences, and of all words.

    Gives (lang, phrase, words, f) and (lang, n). Everything is by language; null is ``other``. Texts are lower-cased in
    A-Z and cut into pieces at ``.,;:!?`` and line ends; a phrase lies within a piece. Null and empty texts have no words.
    Repeated rows count as often as they come. Other columns are not read. A text of any length is taken whole, a run
    of it at a time; only a single word is never cut. An empty table gives no rows.
    """
    if not 1 <= max_words <= 8 or min_count < 1:
        raise ValueError("phrases have 1 to 8 words, and the least count is 1")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(other)).alias("lang"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = int(min(MOST_ROUTES, max(1, -(-size // route_bytes))))
    prefixes = scratch.table(
        rows.mapInArrow(_heavy(count, max_words), PREFIXES).groupBy("lang", "first", "second").agg(F.sum("n").alias("n")), "prefixes"
    )
    totals = prefixes.where("first is null").select("lang", "n")
    everything = totals.agg(F.sum("n")).first()[0] or 0
    # A prefix with a route's share has half of that share in the runs where it has half of it or more.
    found = prefixes.where(F.col("first").isNotNull() & (F.col("n") >= max(1, everything // (2 * count))))
    heavy = [(x, bytes(a), None if b is None else bytes(b)) for x, a, b in found.select("lang", "first", "second").collect()] if count > 1 else []
    routes = Routes(count, heavy)
    routed = rows.mapInArrow(_route(routes, max_words), SUFFIXES)
    mined = routed.groupBy("route", "lang").applyInArrow(_mine(min_count, max_words), COUNTS)
    summed = mined.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)
    return scratch.table(summed, "phrases"), totals


def collocations(
    docs: DataFrame,
    scratch: Scratch,
    min_words: int = 2,
    max_words: int = 3,
    min_count: int = 10,
    cover_percent: int = 50,
    top: int | None = 2000,
    **columns,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` its first and second part at the cut with the lowest score
    floor(1000000 a a / (l r)), the shortest first part among equals. A phrase goes that lies in a longer one with at
    least ``cover_percent`` of its count. Order: score and a descending, phrase by UTF-8 bytes, so that ties are settled
    by the text. For the rows that are read and their nulls, see ``phrase_counts``. ``top`` None gives every phrase.
    """
    if not 2 <= min_words <= max_words:
        raise ValueError("a phrase has two words at least")
    f, totals = phrase_counts(docs, scratch, max_words, min_count, **columns)
    own = f.where(F.col("words") >= min_words)
    parts = F.split("phrase", " ")
    cuts = own.select(
        "lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), "words", parts.alias("_w")
    ).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("_w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("_w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"),
    )
    first = f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rest = f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    # Exact in decimals of 38 digits: a a is below 10^32 for any corpus that a count of 64 bits can hold at the least count.
    score = F.expr("cast((cast(1000000 as decimal(38,0)) * a * a) div (cast(l as decimal(38,0)) * r) as bigint)")
    scored = (
        cuts.join(first, ["lang", "left"])
        .join(rest, ["lang", "right"])
        .withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("_best"))
        .select("lang", "phrase", "a", "_best.l", "_best.r", "_best.score")
    )
    inner = own.where(F.col("words") > min_words).select(
        "lang",
        F.col("f").alias("longer"),
        F.explode(
            F.expr(
                f"flatten(transform(sequence({min_words}, words - 1), n -> transform(sequence(1, words - n + 1),"
                " i -> array_join(slice(split(phrase, ' '), i, n), ' '))))"
            )
        ).alias("phrase"),
    )
    covered = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = (
        scored.join(covered, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (100 * F.col("longer") < cover_percent * F.col("a")))
        .drop("longer")
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:
        # First within buckets, so that the last window has RANK_BUCKETS * top rows of a language at most.
        bucket = F.pmod(F.xxhash64("phrase"), F.lit(RANK_BUCKETS))
        kept = (
            kept.withColumn("_bucket", bucket)
            .withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_bucket").orderBy(*order)))
            .where(F.col("_rank") <= top)
            .drop("_rank", "_bucket")
        )
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
