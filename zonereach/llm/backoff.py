"""Language-model scores from a weighted backoff automaton over words.

States are the root, one per context word and, at order three, one per pair of words; a state's arcs are the n-grams seen
in training, and its failure arc leads to the state of its shorter context at the cost of the backoff weight. A text is scored in one traversal from left to right that carries
the state and adds up log-probabilities.

The model grows with the corpus, so no task and no broadcast ever holds it. Documents are dealt into blocks; a block
sends the distinct words (128 bits each) and pairs (64 bits) it has, with its training counts, to shards by range; a shard adds up
the blocks and answers each with the corpus counts of just its own keys, in the same order; the block then builds the
part of the automaton that its texts can reach, which scores them exactly as the whole automaton would.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text_arrays import Words, mixed

END = np.uint64(0x6A09E667F3BCC909)
BEGIN = np.uint64(0xBB67AE8584CAA73B)
BASE_ADD = 0.1
DISCOUNT = 0.6
# Pseudo-counts of a context seen c times: how many different words follow grows like a power of c.
PSEUDO, GROWTH = 2.0, 0.9
RUN = 256
BLOCK_BYTES = 8_000_000


def pair_keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(context * np.uint64(0x9E3779B97F4A7C15) + word)


class Block:
    """The tokens of a block of texts: 64 bits of their digests, first token a text, contexts.

    ``marks`` has 64 more bits for each distinct token in order, so that words are counted by 128 bits. The distinct
    words of the block are told apart by their bytes before they are hashed. ``place`` is each token's number among the
    distinct ones, so that no token is looked up by its hash.
    """

    def __init__(self, texts: pa.Array):
        words = Words(texts, lower=True)
        n = np.diff(words.first)
        self.first = np.append(0, np.cumsum(n + 1))
        known, place = words.distinct()
        digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in known), "<u8").reshape(-1, 2)
        self.tokens = np.insert(digests[:, 0][place], words.first[1:], END)
        keys = np.append(digests[:, 0], END)
        self.words, at, number = np.unique(keys, return_index=True, return_inverse=True)
        self.place = np.insert(number[place], words.first[1:], number[-1])
        self.marks = np.append(digests[:, 1], END)[at]
        self.context = np.empty_like(self.tokens)
        self.context[1:] = self.tokens[:-1]
        self.context[self.first[:-1]] = BEGIN
        self.text = np.repeat(np.arange(len(n)), n + 1)

    def triples(self) -> tuple[np.ndarray, np.ndarray]:
        """Places with two tokens before them, the begin among these, and the keys of the three."""
        inner = np.ones(len(self.tokens), bool)
        inner[self.first[:-1]] = False
        at = np.flatnonzero(inner)
        return at, pair_keys(pair_keys(self.context[at - 1], self.tokens[at - 1]), self.tokens[at])

    def keys(self, order: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
        """Name, keys and texts of the n-grams of each length up to ``order``."""
        out = [("word", self.tokens, self.text), ("pair", pair_keys(self.context, self.tokens), self.text)]
        if order > 2:
            at, keys = self.triples()
            out.append(("gram", keys, self.text[at]))
        return out

    def tables(self, order: int) -> list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
        """Of the n-grams of each length: name, distinct keys in order, the number of each n-gram among them, its text."""
        (name, _, text), *longer = self.keys(order)
        return [(name, self.words, self.place, text), *((n, *_numbered(keys), of) for n, keys, of in longer)]


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the number of each key among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    head = np.append(True, ordered[1:] != ordered[:-1])[: len(keys)]
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(head) - 1
    return ordered[head], which


def _counted(keys: np.ndarray, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each stands in training."""
    order = np.argsort(keys)
    keys, training = keys[order], training[order]
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[head], np.add.reduceat(training.astype(np.int64), head) if len(keys) else np.empty(0, np.int64)


def _bytes(x: np.ndarray, kind: str) -> bytes:
    """Byte by byte of all numbers, so that what they share lies together and packs well."""
    return x.astype(kind).view(np.uint8).reshape(len(x), np.dtype(kind).itemsize).T.tobytes()


def _numbers(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the sorted keys of each shard begin; a shard is a range of hashes."""
    edges = np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _names(order: int) -> list[str]:
    return ["word", "pair", "gram"][:order]


def _counts_schema(order: int) -> str:
    return "shard int, block int, marks binary, " + ", ".join(f"{n}s binary, {n}_counts binary" for n in _names(order))


def _answers_schema(order: int) -> str:
    return "block int, shard int, n long, v long, " + ", ".join(f"{n}_counts binary" for n in _names(order))


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _count(shards: int, order: int = 2):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        block = Block(table.column("text").combine_chunks())
        training = table.column("training").combine_chunks().to_numpy(zero_copy_only=False)
        out = {"shard": pa.array(range(shards), pa.int32()), "block": pa.array([key[0].as_py()] * shards, pa.int32())}
        for name, keys, which, texts in block.tables(order):
            counts = np.bincount(which, weights=training[texts], minlength=len(keys))
            at = _cuts(keys, shards)
            own = list(zip(at, at[1:]))
            out[f"{name}s"] = pa.array([_bytes(keys[a:b], "<u8") for a, b in own], pa.binary())
            if name == "word":
                out["marks"] = pa.array([_bytes(block.marks[a:b], "<u8") for a, b in own], pa.binary())
            out[f"{name}_counts"] = pa.array([_bytes(counts[a:b], "<u4") for a, b in own], pa.binary())
        return pa.table(out).select(_columns(_counts_schema(order)))

    return run


def _answer(table: pa.Table) -> pa.Table:
    order = sum(f"{n}s" in table.column_names for n in _names(3))
    out = {"block": table.column("block"), "shard": table.column("shard")}
    for name in _names(order):
        keys = [_numbers(x.as_py(), "<u8") for x in table.column(f"{name}s")]
        sizes = [len(k) for k in keys]
        keys = np.concatenate(keys)
        counts = np.concatenate([_numbers(x.as_py(), "<u4") for x in table.column(f"{name}_counts")])
        if name == "word":
            marks = np.concatenate([_numbers(x.as_py(), "<u8") for x in table.column("marks")])
            by = np.lexsort((marks, keys))
            head = np.append(True, (keys[by][1:] != keys[by][:-1]) | (marks[by][1:] != marks[by][:-1])) if len(keys) else np.empty(0, bool)
        else:
            by = np.argsort(keys)
            head = np.append(True, keys[by][1:] != keys[by][:-1]) if len(keys) else np.empty(0, bool)
        which = np.empty(len(keys), np.int64)
        which[by] = np.cumsum(head) - 1
        totals = np.bincount(which, weights=counts).astype(np.int64) if len(keys) else np.empty(0, np.int64)
        if name == "word":
            out["n"] = pa.array([int(totals.sum())] * len(table), pa.int64())
            out["v"] = pa.array([int((totals > 0).sum())] * len(table), pa.int64())
        cuts = np.cumsum(sizes)[:-1]
        out[f"{name}_counts"] = pa.array([_bytes(x, "<u8") for x in np.split(totals[which], cuts)], pa.binary())
    return pa.table(out).select(_columns(_answers_schema(order)))


class Automaton:
    """The states and arcs that the keys of one block can reach.

    A context word seen in training is a state. Its weights follow from the counts c, the words' probabilities P and
    the pseudo-counts m of the context: an arc weighs (c(hw) + m P(w)) / (c(h) + m), the failure arc m / (c(h) + m);
    the root's arcs weigh P(w), absolute discounting with what it frees spread over the V + 1 words, the unknown one
    included. The weights that leave a state sum to one over these words.

    With ``grams`` a pair of words seen in training is a state too, and its failure arc leads to the state of its second
    word: an arc weighs (c(uvw) + m P(w|v)) / (c(uv) + m), with the weights of that state for P.
    """

    def __init__(self, words, word_counts, pairs, pair_counts, n: int, v: int, grams=None, gram_counts=None):
        self.words, self.counts, self.n, self.v = words, word_counts, n, v
        freed = DISCOUNT * v / n / (v + 1) if n else 1.0 / (v + 1)
        self.root = np.maximum(word_counts - DISCOUNT, 0) / max(n, 1) + freed
        self.pairs, self.pair_counts = pairs, pair_counts
        end = np.searchsorted(words, END)
        texts = int(word_counts[end]) if end < len(words) and words[end] == END else 0
        # State 0 is the root, 1 the begin of a text, then one a word; a context never seen in training is the root.
        self.seen = np.concatenate([[0, texts], word_counts]).astype(np.float64)
        pseudo = PSEUDO * np.maximum(self.seen, 1) ** GROWTH
        self.share = pseudo / (self.seen + pseudo)
        self.state_hash = np.concatenate([[np.uint64(0), BEGIN], words])
        self.grams, self.gram_counts = grams, gram_counts
        seen = pair_counts.astype(np.float64)
        pseudo = PSEUDO * np.maximum(seen, 1) ** GROWTH
        self.pair_share = pseudo / (seen + pseudo)

    @staticmethod
    def _found(table: np.ndarray, counts: np.ndarray, keys: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key in the table, and its count; 0 for keys that are not there and where ``of`` is false."""
        if not len(table):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, np.where(of & (table[at] == keys), counts[at], 0)

    def traverse(self, tokens: np.ndarray, first: np.ndarray, word: np.ndarray | None = None, arc: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of each text.

        ``word`` and ``arc`` are the numbers of the tokens among the words, and of each token with the one before it among
        the pairs, where they are known; the arc is the one that leads on from the state of that token before. Texts go side by side; a long one is cut into runs of RUN tokens. A run begins in the state that the tokens
        before it lead to, which the last ones alone decide: one, or two where pairs are states.
        """
        if word is None:
            word = np.searchsorted(self.words, tokens)
        if arc is None:
            context = np.append(BEGIN, tokens[:-1])[: len(tokens)]
            context[first[:-1]] = BEGIN
            arc, arc_counts = self._found(self.pairs, self.pair_counts, pair_keys(context, tokens), np.ones(len(tokens), bool))
        else:
            arc_counts = self.pair_counts[arc]
        texts = np.diff(first)
        pieces = -(-texts // RUN)
        text = np.repeat(np.arange(len(texts)), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = first[:-1][text] + number * RUN
        lengths = np.minimum(RUN, first[1:][text] - starts)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths, text, number = starts[order], lengths[order], text[order], number[order]
        state = np.where(number == 0, 1, word[starts - 1] + 2)
        state = np.where(self.seen[state] > 0, state, 0)
        # The pair that is a state, or -1.
        pair = np.full(len(starts), -1)
        if self.grams is not None:
            later = number > 0
            back = starts[later] - 1
            context = np.where(back == first[:-1][text[later]], BEGIN, tokens[back - 1])
            at, count = self._found(self.pairs, self.pair_counts, pair_keys(context, tokens[back]), np.ones(len(back), bool))
            pair[later] = np.where(count > 0, at, -1)
        total = np.zeros(len(starts))
        for step in range(int(lengths.max()) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -step, side="left"))
            here = starts[:live] + step
            w, s, at = word[here], state[:live], arc[here]
            # The root has no pairs: a context never seen is no state, and its arcs are not there.
            count = np.where(s > 0, arc_counts[here], 0)
            # No arc: over the failure arc to the root, and from there. The root itself has no failure.
            share = np.where(s > 0, self.share[s], 1.0)
            weight = share * self.root[w]
            on = count > 0
            weight[on] += (1 - share[on]) * count[on] / self.seen[s[on]]
            if self.grams is not None:
                p = pair[:live]
                held = np.flatnonzero(p >= 0)
                own = p[held]
                _, third = self._found(self.grams, self.gram_counts, pair_keys(self.pairs[own], self.words[w[held]]), np.ones(len(held), bool))
                share = self.pair_share[own]
                weight[held] = share * weight[held] + (1 - share) * third / self.pair_counts[own]
                pair[:live] = np.where(on & (self.words[w] != END), at, -1)
            total[:live] += np.log10(weight)
            state[:live] = np.where(self.seen[w + 2] > 0, w + 2, 0)
        return np.bincount(text, weights=total, minlength=len(texts))


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
    names = _columns(SCORES)
    if not len(table):
        return pa.table({n: [] for n in names}).cast(
            pa.schema(list(zip(names, [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()])))
        )
    block = Block(table.column("text").combine_chunks())
    answers = answers.take(pa.array(np.argsort(answers.column("shard").to_numpy())))
    order = sum(f"{n}_counts" in answers.column_names for n in _names(3))
    n, v = (int(answers.column(c).to_numpy().sum()) for c in ("n", "v"))
    tables, places = [], []
    for name, keys, which, _ in block.tables(order):
        counts = np.concatenate([_numbers(x.as_py(), "<u8") for x in answers.column(f"{name}_counts")]).astype(np.int64)
        if len(keys) != len(counts):
            raise RuntimeError("the block's texts changed between the passes")
        tables += [keys, counts]
        places.append(which)
    automaton = Automaton(*tables[:4], n, v, *tables[4:])
    word_counts = tables[1]
    counts = word_counts[block.place]
    base = np.log10((word_counts + BASE_ADD) / (n + BASE_ADD * (v + 1)))[block.place]
    texts = len(table)
    return pa.table(
        {
            "doc_id": table.column("doc_id"),
            "held_out": pa.array(~table.column("training").combine_chunks().to_numpy(zero_copy_only=False)),
            "n_tokens": pa.array(np.diff(block.first), pa.int64()),
            "n_known": pa.array(np.bincount(block.text, weights=counts > 0, minlength=texts).astype(np.int64)),
            "train_tokens": pa.array(np.full(texts, n, np.int64)),
            "base_score": pa.array(np.bincount(block.text, weights=base, minlength=texts)),
            "score": pa.array(automaton.traverse(block.tokens, block.first, *places[:2])),
        }
    )


def backoff_scores(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fold: int = 10, block_bytes: int = BLOCK_BYTES, order: int = 2
) -> DataFrame:
    """Score all texts: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    The model learns from the documents whose crc32(doc_id as text) mod ``fold`` is not 0; counts cover all of them.
    Words are lower-cased in A-Z; a text ends with one end token. Null and empty texts are the end token alone. Null
    ids count as empty text in the fold. Repeated rows count and are scored as often as they come. Without any
    training text all words are unknown (train_tokens 0). An empty table gives no rows. Other columns are not read.
    ``order`` is the length of the longest n-grams: 2, or 3 with pairs of words as states that fail to their second word.

    A block has about ``block_bytes`` of text (a longer text is a block by itself); its words, pairs and their counts
    are what a task holds, and a shard as many keys as a block. Raise it with the executors' memory.
    """
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    fresh = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (F.crc32(fresh.cast("binary")) % fold != 0).alias("training"),
    )
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 1
    count = int(max(1, -(-size // block_bytes)))
    # A hash of id and text: copies of an id or of a text do not make a block larger by themselves.
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).cast("int")
    blocks = rows.withColumn("block", block).repartition(count, "block")
    counted = blocks.groupBy("block").applyInArrow(_count(count, order), _counts_schema(order))
    answers = counted.groupBy("shard").applyInArrow(_answer, _answers_schema(order))
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score, SCORES)
