"""Scores of texts by a trigram model that is kept as shards of an Elias-Fano trie.

Tokens travel in blocks of documents, as one row of bytes for a block and shard, so an n-gram is asked for once for each
block that holds it, however often it occurs. Blocks ask shards of words for counts and numbers, and shards of pairs and
of triples for counts; what the shards tell comes back to the blocks, which discount and add up by document.
A row goes only from a block to a shard that it has n-grams for, so rows are never more than n-grams.
"""

from __future__ import annotations

from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import cut, passing
from headway.llm.elias_fano import Mapped

#: What ends a text, and stands before the next one's first word; no word has white space.
END = b"\n"
FOLDS = 10
#: Tokens in a block, and the mean in a shard.
BLOCK, SHARD = 2_000_000, 2_000_000
#: The discount where nothing occurs twice.
DISCOUNT = 0.75

U = np.uint64


def held_out(doc_id: int | None) -> bool:
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == 0


def pack(*arrays: np.ndarray) -> bytes:
    """Compressed, with the bytes of a place next to each other, behind the arrays' lengths."""
    parts = [np.array([len(arrays), *map(len, arrays)], U).tobytes()]
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
        parts.append(np.ascontiguousarray(planes).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(b: bytes, *types) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    at, out = 8 + 8 * len(types), []
    for n, t in zip(raw[8:at].view(U).astype(np.int64).tolist(), map(np.dtype, types)):
        out.append(np.ascontiguousarray(raw[at : at + n * t.itemsize].reshape(t.itemsize, n).T).view(t).reshape(-1))
        at += n * t.itemsize
    return out


def steps(a: np.ndarray) -> np.ndarray:
    """An array of sorted runs as differences, whose upper bytes are mostly zero; cumsum undoes it."""
    return np.diff(a, prepend=a.dtype.type(0))


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, number of each key among them). A key and its place are sorted as one number if they fit."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    bits = len(keys).bit_length()
    if int(keys.max()).bit_length() + bits > 64:
        return np.unique(keys, return_inverse=True)
    both = (keys.astype(U) << U(bits)) | np.arange(len(keys), dtype=U)
    both.sort()
    places = (both & U((1 << bits) - 1)).astype(np.int64)
    both >>= U(bits)
    new = changes(both)
    number = np.empty(len(keys), np.int64)
    number[places] = np.cumsum(new) - 1
    return both[new].astype(keys.dtype), number


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BLOCKS = "block long, n long, docs array<long>, lengths array<long>, held array<boolean>, data binary"
BLOCKS_ARROW = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("data", pa.binary())])
#: What goes from a block to a shard, and back. Of block -1 are a shard's sums.
ASK, ASK_ARROW = "shard long, block long, data binary", pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("data", pa.binary())])
TELL, TELL_ARROW = "block long, level long, shard long, data binary", pa.schema([("block", pa.int64()), ("level", pa.int64()), ("shard", pa.int64()), ("data", pa.binary())])


def blocks(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """Documents by blocks of about `size` tokens: ids, lengths, folds, hashes of the words, tokens as numbers of words."""

    def run(batches):
        made = 0
        ids: list = []
        lengths: list[int] = []
        tokens: list[int] = []
        number = count()

        class Numbers(dict):
            def __missing__(self, word):
                self[word] = n = next(number)
                return n

        seen = Numbers()

        def flush():
            nonlocal made, ids, lengths, tokens, number, seen
            t = np.array(tokens, np.int64)
            vocab = np.fromiter(map(xxhash.xxh64_intdigest, seen), U, len(seen))
            order = np.argsort(-np.bincount(t, minlength=len(vocab)), kind="stable")  # frequent words get small numbers, which pack well
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order))
            row = {"block": [(TaskContext.get().partitionId() << 32) + made], "n": [len(t)], "docs": [ids], "lengths": [lengths], "held": [[held_out(d) for d in ids]], "data": [pack(vocab[order], place[t])]}
            made, ids, lengths, tokens, number = made + 1, [], [], [], count()
            seen = Numbers()
            return pa.RecordBatch.from_pydict(row, BLOCKS_ARROW)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
                words.append(END)
                tokens.extend(map(seen.__getitem__, words))
                ids.append(doc)
                lengths.append(len(words))
                if len(tokens) >= size:
                    yield flush()
        if ids:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, BLOCKS)


class Block:
    """A row of blocks, unpacked; told, what shards told it."""

    def __init__(self, row: dict, told: pa.Table | None = None):
        self.number, self.docs, self.lengths, self.held = row["block"], row["docs"], np.array(row["lengths"]), np.array(row["held"], bool)
        self.vocab, tokens = unpack(row["data"], U, np.uint32)
        self.tokens = tokens.astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.trains = ~self.held[self.doc]
        self.starts = np.zeros(len(self.tokens), bool)
        self.starts[np.cumsum(self.lengths) - self.lengths] = True
        self.told: dict[int, list[bytes]] = {}
        for r in sorted(told.to_pylist(), key=lambda r: r["shard"]) if told is not None else ():
            self.told.setdefault(r["level"], []).append(r["data"])

    def answers(self, level: int, *types) -> list[np.ndarray]:
        found = [unpack(b, *types) for b in self.told.get(level, ())]
        return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, t) for t in types]

    def number_words(self) -> None:
        """From here on tokens are places among the block's known words, in the order of their corpus-wide numbers; all
        unknown words are place 0."""
        numbers, seen = self.answers(1, np.uint32, U)
        order = np.argsort(self.vocab)
        self.gid, self.seen = np.zeros(len(self.vocab), U), np.zeros(len(self.vocab), np.int64)
        self.gid[order], self.seen[order] = numbers, seen
        known = np.flatnonzero(self.gid)
        known = known[np.argsort(self.gid[known])]
        place = np.zeros(len(self.vocab), np.int64)
        place[known] = np.arange(1, len(known) + 1)
        end = place[np.flatnonzero(self.vocab == U(xxhash.xxh64_intdigest(END)))[0]]
        self.tokens = place[self.tokens]
        self.gid, self.seen = np.append(U(0), self.gid[known]), np.append(0, self.seen[known])
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[self.starts] = end

    def pairs(self) -> "Grams":
        """Pairs after known words."""
        asked = np.flatnonzero(self.before > 0)
        key, number = distinct(self.before[asked] * len(self.gid) + self.tokens[asked])
        first, second = key // len(self.gid), key % len(self.gid)
        return Grams(self, asked, number, self.gid[first], self.seen[first], first, second)

    def triples(self, pairs: "Grams", seen: np.ndarray) -> "Grams":
        """Triples whose first two words, a pair that training has `seen`, are of one text."""
        pair = np.full(len(self.tokens), -1)
        pair[pairs.asked] = pairs.number
        pair[1:], pair[0] = pair[:-1], -1
        pair[self.starts] = -1
        after = np.flatnonzero(pair >= 0)
        pair[after[seen[pair[after]] == 0]] = -1
        asked = np.flatnonzero(pair >= 0)
        key, number = distinct(pair[asked] * len(self.gid) + self.tokens[asked])
        first, second = key // len(self.gid), key % len(self.gid)
        context = (pairs.context[first] << U(32)) | self.gid[pairs.word[first]]
        return Grams(self, asked, number, context, seen[first], first, second)


class Grams:
    """A block's distinct n-grams in the order of contexts and words: where they occur, what they follow and how often
    training has that."""

    def __init__(self, block: Block, asked, number, context, seen, first, word):
        self.block, self.asked, self.number, self.context, self.seen, self.first, self.word = block, asked, number, context, seen, first, word

    def deal(self, total: int, shards: int) -> None:
        """Orders them by shard. A context's n-grams share a shard, unless it is so frequent that they are dealt to several
        by their words."""
        ways = split(self.seen, total, shards)
        salt = mix(self.block.gid[self.word]) % ways.astype(U)
        shard = mix(self.context * U(0x9E3779B97F4A7C15) + salt) % U(shards)
        self.order = np.argsort(shard.astype(np.uint16 if shards < 1 << 16 else np.int64), kind="stable")
        shard = shard[self.order]
        self.edge = np.searchsorted(shard, np.arange(shards + 1, dtype=U))
        self.starts = np.flatnonzero(changes(self.first[self.order], shard))
        self.context_edge = np.searchsorted(self.starts, self.edge)

    def ask(self) -> list[dict]:
        """A row for each shard: contexts, how many n-grams each has, how often training has it; words and their counts."""
        block, o = self.block, self.order
        n = np.bincount(self.number[block.trains[self.asked]], minlength=len(self.word))[o].astype(np.uint32)
        word, context, seen = block.gid[self.word[o]].astype(np.uint32), self.context[o[self.starts]], self.seen[o[self.starts]].astype(U)
        sizes = np.diff(np.append(self.starts, len(o))).astype(np.uint32)
        out = []
        for s in np.flatnonzero(np.diff(self.edge)).tolist():
            x, y = self.edge[s], self.edge[s + 1]
            a, b = self.context_edge[s], self.context_edge[s + 1]
            out.append({"shard": s, "block": block.number, "data": pack(steps(context[a:b]), sizes[a:b], seen[a:b], word[x:y], n[x:y])})
        return out

    def back(self, values: np.ndarray, of_contexts: bool = False) -> np.ndarray:
        """Values in the order of the rows asked (for each n-gram or each context), by n-gram."""
        if of_contexts:
            values = np.repeat(values, np.diff(np.append(self.starts, len(self.order))))
        out = np.empty(len(self.order), values.dtype)
        out[self.order] = values
        return out


def split(seen: np.ndarray, total: int, shards: int) -> np.ndarray:
    """To how many shards the n-grams of a context are dealt: more than one if it has over half a shard's tokens."""
    return 1 + seen * shards * 2 // max(1, total)


def word_shards(vocab: np.ndarray, shards: int) -> np.ndarray:
    """A shard is a range of hashes, so a block's sorted words fall into runs."""
    return ((vocab >> U(32)) * U(shards) >> U(32)).astype(np.int64)


def ask_words(cut_blocks: DataFrame, shards: int) -> DataFrame:
    """Each block's words and training counts, a row for each shard."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                block = Block(row)
                order = np.argsort(block.vocab)
                keys, n = block.vocab[order], np.bincount(block.tokens[block.trains], minlength=len(order))[order].astype(np.uint32)
                edge = np.searchsorted(word_shards(keys, shards), np.arange(shards + 1))
                out = [{"shard": s, "block": row["block"], "data": pack(steps(keys[a:e]), n[a:e])} for s, (a, e) in enumerate(zip(edge, edge[1:])) if a < e]
                yield from pa.Table.from_pylist(out, ASK_ARROW).to_batches()

    return cut_blocks.mapInArrow(run, ASK)


def tell_words(shards: int):
    """One shard: numbers (frequent words' are small) and training counts of the words, to each block that asks."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        shard = rows[0]["shard"]
        asked = [unpack(r["data"], U, np.uint32) for r in rows]
        vocab, at = np.unique(np.concatenate([np.cumsum(k, dtype=U) for k, _ in asked]), return_inverse=True)
        n = np.bincount(at, np.concatenate([c for _, c in asked]), len(vocab)).astype(np.int64)
        number = np.zeros(len(vocab), np.int64)
        order = np.argsort(-n, kind="stable")
        number[order] = 1 + shard + shards * np.arange(len(vocab))
        number[n == 0] = 0
        if len(number) and number.max() >= 1 << 32:
            raise ValueError("over four billion known words")
        out, start = [], 0
        for r, (k, _) in zip(rows, asked):
            here = at[start : start + len(k)]
            out.append({"block": r["block"], "level": 1, "shard": shard, "data": pack(number[here].astype(np.uint32), n[here].astype(U))})
            start += len(k)
        out.append({"block": -1, "level": 1, "shard": shard, "data": pack(np.array([n.sum(), (n > 0).sum()], np.int64))})
        return pa.Table.from_pylist(out, TELL_ARROW)

    return run


class Merged:
    """The n-grams that blocks ask a shard for, each once, with training counts over all blocks."""

    def __init__(self, rows: list[dict]):
        asked = [unpack(r["data"], U, np.uint32, U, np.uint32, np.uint32) for r in rows]
        self.context_lengths, self.lengths = [len(a[0]) for a in asked], [len(a[3]) for a in asked]
        self.contexts, self.context_at = np.unique(np.concatenate([np.cumsum(a[0], dtype=U) for a in asked]), return_inverse=True)
        self.seen = np.zeros(len(self.contexts), np.int64)
        self.seen[self.context_at] = np.concatenate([a[2] for a in asked])
        key = (np.repeat(self.context_at, np.concatenate([a[1] for a in asked])).astype(U) << U(32)) | np.concatenate([a[3] for a in asked])
        order = np.argsort(key, kind="stable")  # the rows are sorted runs
        key = key[order]
        new = changes(key)
        key = key[new]
        self.at = np.empty(len(order), np.int64)
        self.at[order] = np.cumsum(new) - 1
        self.n = np.bincount(self.at, np.concatenate([a[4] for a in asked]), len(key)).astype(np.int64)
        self.context, self.word = (key >> U(32)).astype(np.int64), key & U((1 << 32) - 1)
        self.kinds = np.bincount(self.context[self.n > 0], minlength=len(self.contexts))

    def tell(self, rows: list[dict], level: int, values: np.ndarray, total: int, shards: int, sums: list[np.ndarray]) -> pa.Table:
        """Each block's n-grams' values and, for each of its contexts, how many words follow it; and the shard's sums,
        with its part of those numbers for contexts that were dealt to several shards. An n-gram is in one shard, so
        shards' sums add up."""
        out, x, y = [], 0, 0
        for r, a, b in zip(rows, self.context_lengths, self.lengths):
            out.append({"block": r["block"], "level": level, "shard": r["shard"], "data": pack(self.kinds[self.context_at[x : x + a]].astype(np.uint32), values[self.at[y : y + b]])})
            x, y = x + a, y + b
        hot = split(self.seen, total, shards) > 1
        out.append({"block": -1, "level": level, "shard": rows[0]["shard"], "data": pack(self.contexts[hot], self.kinds[hot], *sums)})
        return pa.Table.from_pylist(out, TELL_ARROW)


def ask_pairs(total: int, shards: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[dict] = []
        for row in left.to_pylist():
            block = Block(row, right)
            block.number_words()
            pairs = block.pairs()
            pairs.deal(total, shards)
            out += pairs.ask()
        return pa.Table.from_pylist(out, ASK_ARROW)

    return run


def once_and_twice(n: np.ndarray) -> np.ndarray:
    """How many n-grams training has once and twice."""
    return np.array([(n == 1).sum(), (n == 2).sum()], np.int64)


def tell_pairs(total: int, shards: int):
    """One shard: the pairs' training counts over all blocks, which the next level's contexts need, to each block."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        m = Merged(rows)
        return m.tell(rows, 2, m.n.astype(U), total, shards, [once_and_twice(m.n)])

    return run


def ask_triples(total: int, shards: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[dict] = []
        for row in left.to_pylist():
            block = Block(row, right)
            block.number_words()
            pairs = block.pairs()
            pairs.deal(total, shards)
            triples = block.triples(pairs, pairs.back(block.answers(2, np.uint32, U)[1].astype(np.int64)))
            triples.deal(total, shards)
            out += triples.ask()
        return pa.Table.from_pylist(out, ASK_ARROW)

    return run


def tell_triples(total: int, shards: int):
    """One shard: a trie of the triples that training has, with their counts as places among the distinct ones, is asked
    for all that blocks ask for."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        m = Merged(rows)
        first, second = m.contexts >> U(32), m.contexts & U((1 << 32) - 1)
        has = np.flatnonzero(m.n)
        of = m.context[has]
        counts, codes = np.unique(m.n[has], return_inverse=True)
        with Mapped([first[of], second[of], m.word[has]], codes) as trie:
            pair = trie.descend(1, trie.descend(0, np.zeros(len(first), np.int64), first), second)
            at = trie.descend(2, pair[m.context], m.word)
            found = np.where(at >= 0, counts[trie.codes[np.maximum(at, 0)]], 0) if len(has) else np.zeros(len(at))
        return m.tell(rows, 3, found.astype(U), total, shards, [once_and_twice(m.n)])

    return run


def plain(n: np.ndarray, total: int, words: int) -> np.ndarray:
    """The base probability of words seen n times in training."""
    return (n + 0.1) / (total + 0.1 * (words + 1))


OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def add_up(total: int, words: int, shards: int, discounts: tuple[float, float], hot: dict[int, tuple[np.ndarray, np.ndarray]]):
    def followers(grams: Grams, level: int, told: np.ndarray) -> np.ndarray:
        """How many words follow each n-gram's context in training, over all shards."""
        n = grams.back(told.astype(np.int64), of_contexts=True)
        contexts, kinds = hot[level]
        if len(contexts):
            at = np.minimum(np.searchsorted(contexts, grams.context), len(contexts) - 1)
            n = np.where(contexts[at] == grams.context, kinds[at], n)
        return n

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        for row in left.to_pylist():
            block = Block(row, right)
            block.number_words()
            p = plain(block.seen, total, words)[block.tokens]
            add = lambda x: np.bincount(block.doc, x, len(block.docs))  # noqa: E731, B023
            base, known = add(np.log10(p)), add((block.tokens > 0).astype(float)).astype(np.int64)
            pairs = block.pairs()
            pairs.deal(total, shards)
            kinds, n = block.answers(2, np.uint32, U)
            n, kinds = pairs.back(n.astype(np.int64)), followers(pairs, 2, kinds)
            rest = discounts[0] * kinds / np.maximum(1, pairs.seen)
            own = np.maximum(0, n - discounts[0]) / np.maximum(1, pairs.seen)
            p[pairs.asked] = own[pairs.number] + rest[pairs.number] * p[pairs.asked]
            triples = block.triples(pairs, n)
            triples.deal(total, shards)
            kinds, n = block.answers(3, np.uint32, U)
            rest = discounts[1] * followers(triples, 3, kinds) / np.maximum(1, triples.seen)
            own = np.maximum(0, triples.back(n.astype(np.int64)) - discounts[1]) / np.maximum(1, triples.seen)
            p[triples.asked] = own[triples.number] + rest[triples.number] * p[triples.asked]
            tables.append(pa.Table.from_arrays([pa.array(block.docs, pa.int64()), pa.array(block.held), pa.array(block.lengths), pa.array(known), pa.array(np.full(len(known), total)), pa.array(base), pa.array(add(np.log10(p)))], schema=OUT_ARROW))
        return pa.concat_tables(tables) if tables else OUT_ARROW.empty_table()

    return run


def _sums(told: DataFrame, *types) -> list[list[np.ndarray]]:
    """The shards' sums: a row for each two million tokens, of a few numbers and the shard's share of split contexts."""
    return [unpack(r.data, *types) for r in told.where("block = -1").select("data").toLocalIterator()]


def _hot(sums: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(contexts dealt to several shards, how many words follow each); each has half a shard's tokens at least."""
    contexts, at = np.unique(np.concatenate([s[0] for s in sums] or [np.zeros(0, U)]), return_inverse=True)
    return contexts, np.bincount(at, np.concatenate([s[1] for s in sums] or [np.zeros(0)]), len(contexts)).astype(np.int64)


def _discount(sums: list[list[np.ndarray]]) -> float:
    once, twice = sum((s[2] for s in sums), np.zeros(2, np.int64)).tolist()
    return once / (once + 2 * twice) if twice else DISCOUNT


def score(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, slices: int = 1) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): a row for each row of docs (doc_id, text).

    The model is interpolated absolute discounting over the training rows: p(w | u v) = max(0, c(u v w) - d) / c(u v) +
    d k(u v) / c(u v) p(w | v), with k the number of words that follow, likewise p(w | v) from c(v w), and the base
    probability p(w); a context that training has not seen leaves the shorter one's probability. END is the one word before
    a text's first. Each level has one discount d = n1 / (n1 + 2 n2), of the numbers of n-grams that training has once and
    twice; all are counted, so `slices`, of which one was counted once, has no effect. Counts are exact, and a score
    depends neither on the number of shards nor on that of blocks. Shards grow in number with the tokens, so each holds as much as before; a text longer
    than a block is a block of its own. Null and empty texts have the end alone; a row without doc_id is held out; repeated
    rows count each; with no training rows every word is as likely; an empty table gives no rows.
    """
    with passing(docs.sparkSession):
        held = cut(blocks(docs, block))
        shards = int(-(-(held.agg(F.sum("n")).first()[0] or 0) // shard)) or 1
        by_block = held.groupBy("block")
        words_told = cut(ask_words(held, shards).groupBy("shard").applyInArrow(tell_words(shards), TELL))
        total, words = (int(x) for x in sum((s[0] for s in _sums(words_told, np.int64)), np.zeros(2, np.int64)))
        told = words_told.where("block >= 0")
        pairs_asked = by_block.cogroup(told.groupBy("block")).applyInArrow(ask_pairs(total, shards), ASK)
        pairs_told = cut(pairs_asked.groupBy("shard").applyInArrow(tell_pairs(total, shards), TELL))
        told = told.unionByName(pairs_told.where("block >= 0"))
        triples_asked = by_block.cogroup(told.groupBy("block")).applyInArrow(ask_triples(total, shards), ASK)
        triples_told = cut(triples_asked.groupBy("shard").applyInArrow(tell_triples(total, shards), TELL))
        sums = {2: _sums(pairs_told, U, np.int64, np.int64), 3: _sums(triples_told, U, np.int64, np.int64)}
        hot = {level: _hot(s) for level, s in sums.items()}
        discounts = _discount(sums[2]), _discount(sums[3])
    told = told.unionByName(triples_told.where("block >= 0"))
    return by_block.cogroup(told.groupBy("block")).applyInArrow(add_up(total, words, shards, discounts, hot), OUT)
