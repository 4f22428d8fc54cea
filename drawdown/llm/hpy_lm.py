"""Hierarchical Pitman-Yor language model over words, seated by Gibbs sampling.

Tokens are words between ASCII white space with A-Z in lower case, then one end per text; a text begins behind an end. Every token
of the training texts is a context with a restaurant of its own, whose dishes are all words that follow it. Their common parent
restaurant serves all words; its base gives half of its mass to the known words, alike, and half to words never seen.

A Gibbs sweep unseats all customers of a dish in a restaurant and seats them again, given the tables of the other dishes and the
parent's current predictive probability; a word that follows a context once has one table and needs no draw. The customer that opens
the next table is drawn from its exact distribution. After `BURN_IN` sweeps the predictive probabilities of `SAMPLES` sweeps are
averaged. Discounts follow from the numbers of dishes with one and two customers.

The occurrences of all texts are dealt by context to blocks, once: there they are counted and, at last, scored. Contexts that are
among the `SPLIT` most frequent words are dealt by context and word. Words are dealt to fewer buckets, where the parent seats them. A
sweep sends each bucket the sums of tables of a block's words and each block the customers and tables of these words; what a block or
bucket keeps for itself goes along with its own key. Blocks have about `BLOCK` tokens, so their number grows with the input.

A row's sums of scores over a block travel in single precision.

On the driver or broadcast are the `FREQUENT` most frequent words, which travel under short codes, and the totals of the split
contexts. Words are told apart by 64 bits of hash.

Defined results: a null text is the empty text, which has only its end; documents with a null id are held out; repeated rows
count and are scored each by itself; behind a context never seen the parent's probability holds; without training rows every
token is unknown and the model is its base. Extra columns play no part.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawdown.llm.common import ship
from drawdown.session import materialise

BURN_IN, SAMPLES, STRENGTH = 4, 6, 1.0
#: Share of the parent's base on known words.
SEEN = 0.5
#: Added to counts by the base score.
ADDED = 0.1
#: Tokens handled at once, and tokens of a block.
CHUNK, BLOCK = 1_000_000, 2_000_000
#: Bytes of text split at once.
SLICE = 4_000_000
#: Blocks for each bucket.
SHARED = 8
#: Words with short codes, and contexts whose words are dealt over all blocks.
FREQUENT, SPLIT = 65_535, 64
FOLDS = 10
COUNTS = "word BIGINT, n BIGINT"
DEALT = "block INT, kind STRING, chunk BIGINT, body BINARY"
SCORES = "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, base_score DOUBLE, score DOUBLE"


def end() -> np.ndarray:
    """The hash of the token that ends a text."""
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(b"")], dtype=np.uint64)


def tokens(texts: pa.Array) -> list[np.ndarray]:
    """Hashes of each text's tokens."""
    import xxhash

    texts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words = texts.flatten()
    coded = words.cast(pa.binary()).dictionary_encode()
    _, at, data = coded.dictionary.buffers()
    at, data = np.frombuffer(at, np.int32)[: len(coded.dictionary) + 1].tolist(), data.to_pybytes() if data else b""
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(at, at[1:])), np.uint64, len(coded.dictionary))
    # White space at a text's ends leaves empty words.
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    sizes = np.bincount(np.repeat(np.arange(len(texts)), pc.list_value_length(texts).to_numpy(zero_copy_only=False))[real], minlength=len(texts))
    found = hashes[coded.indices.to_numpy(zero_copy_only=False)[real]]
    return np.split(np.insert(found, np.cumsum(sizes), end()[0]), np.cumsum(sizes + 1)[:-1])


def held_out(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def _chunks(batches: Iterator[pa.RecordBatch], train_only: bool) -> Iterator[tuple[list, list[np.ndarray]]]:
    ids, rows, held = [], [], 0
    for batch in batches:
        these, texts = batch.column(0).to_pylist(), batch.column(1)
        if train_only:
            kept = [not held_out(x) for x in these]
            these, texts = [x for x, keep in zip(these, kept) if keep], texts.filter(pa.array(kept, pa.bool_()))
        part = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64) // SLICE
        starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
        for a, b in zip(starts, [*starts[1:], len(these)]):
            for doc_id, row in zip(these[a:b], tokens(texts.slice(a, b - a))):
                ids.append(doc_id)
                rows.append(row)
                held += len(row)
                if held > CHUNK:
                    yield ids, rows
                    ids, rows, held = [], [], 0
    if ids:
        yield ids, rows


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _chunks(batches, True):
        words, n = np.unique(np.concatenate(rows), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])


def narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in as few bytes as hold them."""
    return values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays, compressed; bytes of one place lie together."""
    raw = b"".join(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes() for x in arrays)
    return pickle.dumps(([(x.dtype.str, x.shape) for x in arrays], len(raw), pa.compress(raw, "zstd", asbytes=True) if raw else b""))


def unpack(body: bytes) -> list[np.ndarray]:
    kinds, size, data = pickle.loads(body)
    raw, at, out = np.frombuffer(pa.decompress(data, size, "zstd", asbytes=True) if size else b"", np.uint8), 0, []
    for kind, shape in kinds:
        width, count = np.dtype(kind).itemsize, math.prod(shape)
        out.append(np.ascontiguousarray(raw[at : at + width * count].reshape(width, count).T).view(kind).reshape(shape))
        at += width * count
    return out


@dataclass(frozen=True)
class Menu:
    """The frequent words, which have short codes: by code, most frequent first, with counts; and in order of their hashes."""

    words: np.ndarray
    counts: np.ndarray
    ordered: np.ndarray
    codes: np.ndarray

    def places(self, row: np.ndarray) -> np.ndarray:
        """The code of each token; `FREQUENT` for rarer words."""
        size = len(self.ordered)
        if not size:
            return np.full(len(row), FREQUENT, dtype=np.uint16)
        at = np.minimum(np.searchsorted(self.ordered, row), size - 1)
        return np.where(self.ordered[at] == row, self.codes[at], FREQUENT).astype(np.uint16)

    def spell(self, codes: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """The words of codes; `rare` has the words without one, in order."""
        out = np.empty(len(codes), dtype=np.uint64)
        short = codes < FREQUENT
        out[short], out[~short] = self.words[codes[short]], rare
        return out


def make_menu(top: list[tuple[int, int]]) -> Menu:
    """From (word, count), most frequent first."""
    words = np.array([w for w, _ in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(words)
    return Menu(words, np.array([n for _, n in top], dtype=np.int64), words[order], order)


def seat(customers: np.ndarray, mass, discount: float, rng: np.random.Generator, share=0.0) -> np.ndarray:
    """Tables of a dish after all its customers sat down.

    The chance of a new table for the next of j customers at t tables is m / (m + j - discount * t), where m is `mass`, what there
    is before its first table, and `discount * share` for each of its tables. The first customers come one by one. Then the number
    of customers up to the one that opens the next table is geometric with a chance from a beta distribution.
    """
    mass, share = (np.broadcast_to(np.asarray(x, dtype=float), customers.shape) for x in (mass, share))
    tables = (customers > 0).astype(float)
    at = np.flatnonzero(customers > 1)
    wanted, opens, each, now, seated = customers[at], mass[at], discount * share[at], np.ones(len(at)), 1
    opens = opens + each
    while len(at) and seated < 4:
        new = rng.random(len(at)) * (opens + seated - discount * now) < opens
        now += new
        opens += each * new
        seated += 1
        tables[at] = now
        more = wanted > seated
        at, wanted, opens, each, now = at[more], wanted[more], opens[more], each[more], now[more]
    seated = np.full(len(at), float(seated))
    while len(at):
        if len(at) < 32:
            # Where many tables are to come to few dishes, all remaining customers are drawn at once.
            rest = wanted - seated
            many = rest < 800 * opens * np.log1p(rest / (seated + opens))
            for k in np.flatnonzero(many):
                tables[at[k]] = _seat_rest(int(wanted[k]), int(seated[k]), now[k], opens[k] - each[k] * now[k], each[k], discount, rng)
            at, wanted, opens, each, now, seated = (x[~many] for x in (at, wanted, opens, each, now, seated))
        chance = rng.beta(opens, seated - discount * now)
        wait = np.ceil(rng.standard_exponential(len(at)) / -np.log1p(-np.clip(chance, 1e-300, 1 - 1e-16)))
        seated = seated + np.maximum(wait, 1)
        more = seated <= wanted
        at, wanted, opens, each, now, seated = at[more], wanted[more], opens[more] + each[more], each[more], now[more] + 1, seated[more]
        tables[at] = now
    return tables


def _seat_rest(customers: int, seated: int, tables: float, mass: float, each: float, discount: float, rng: np.random.Generator) -> float:
    """Tables of one dish after its remaining customers.

    Each customer's number decides by the tables before it. A path of tables that is too low is raised until it fits its own
    numbers: the chance rises with the tables, so that the first such path is the one that customers one by one would make.
    """
    while seated < customers:
        n = min(customers - seated, max(seated, 4096), 1 << 18)
        draws, j, before = rng.random(n), seated + np.arange(n), np.full(n, tables)
        while True:
            opens = mass + each * before
            new = draws * (opens + j - discount * before) < opens
            path = tables + np.cumsum(new) - new
            if np.array_equal(path, before):
                break
            before = path
        tables, seated = path[-1] + new[-1], seated + n
    return tables


def discount_of(counts: np.ndarray, weights: np.ndarray | None = None) -> float:
    one = (counts == 1).sum() if weights is None else weights[counts == 1].sum()
    two = (counts == 2).sum() if weights is None else weights[counts == 2].sum()
    return float(np.clip(one / (one + 2 * two), 0.1, 0.9)) if one + two else 0.5


def fit_upper(counts: np.ndarray, seed: int = 1, seen: float = 1.0) -> np.ndarray:
    """log10 predictive probabilities (contexts, dishes), averaged over samples: the model of a table in memory, for tests.

    `seen` is the share of the parent's base on the dishes.
    """
    rng = np.random.default_rng(seed)
    upper, lower = discount_of(counts), discount_of(counts.sum(axis=0))
    base = seen / counts.shape[1]
    tables = (counts > 0).astype(float)
    parent_tables = (tables.sum(axis=0) > 0).astype(float)
    total = counts.sum(axis=1, keepdims=True)
    average = np.zeros(counts.shape)
    row, column = np.nonzero(counts)
    for sweep in range(BURN_IN + SAMPLES):
        seated = tables.sum(axis=0)
        # The parent's customers are its children's tables.
        mass = (STRENGTH + lower * (parent_tables.sum() - parent_tables)) * base
        parent_tables = seat(seated.astype(np.int64), mass, lower, rng, base)
        parent = (seated - lower * parent_tables + (STRENGTH + lower * parent_tables.sum()) * base) / (STRENGTH + seated.sum())
        per_room = tables.sum(axis=1)
        mass = (STRENGTH + upper * (per_room[row] - tables[row, column])) * parent[column]
        tables[row, column] = seat(counts[row, column], mass, upper, rng, parent[column])
        if sweep >= BURN_IN:
            open_mass = STRENGTH + upper * tables.sum(axis=1, keepdims=True)
            average += (counts - upper * tables + open_mass * parent) / (STRENGTH + total)
    return np.log10(average / SAMPLES)


def fit_rare(counts: np.ndarray, words: np.ndarray, seed: int = 2) -> tuple[np.ndarray, float]:
    """log10 probabilities of a word by its count, and of an unseen word, without contexts; `words` have each count. For tests."""
    rng = np.random.default_rng(seed)
    types, customers = float(words.sum()), float((counts * words).sum())
    discount = discount_of(counts, words)
    base = SEEN / max(types, 1.0)
    which = np.repeat(np.arange(len(counts)), words.astype(np.int64))
    tables, mean, unseen = np.ones(len(which)), np.zeros(len(counts)), 0.0
    for sweep in range(BURN_IN + SAMPLES):
        tables = seat(counts[which], (STRENGTH + discount * (tables.sum() - tables)) * base, discount, rng, base)
        if sweep >= BURN_IN:
            mass = STRENGTH + discount * tables.sum()
            each = np.bincount(which, weights=tables, minlength=len(counts)) / np.maximum(words, 1)
            mean += (counts - discount * each + mass * base) / (STRENGTH + customers)
            unseen += mass * (1 - SEEN) / (STRENGTH + customers)
    return np.log10(mean / SAMPLES), float(np.log10(unseen / SAMPLES))


def home(words: np.ndarray, blocks: int) -> np.ndarray:
    """The block of a context, or the bucket of a word."""
    return ((words >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)


def home_of_chunk(chunk: int, blocks: int) -> int:
    return ((chunk >> 33) + (chunk & (1 << 33) - 1)) % blocks


def _deal(chunk: int, ids: list, rows: list[np.ndarray], menu: Menu, floor: float, blocks: int) -> Iterator[tuple[int, str, int, bytes]]:
    """A chunk's rows, training texts first, and for each block the contexts, in runs, with the words behind them and their rows."""
    held = np.array([held_out(x) for x in ids])
    order = np.argsort(held, kind="stable")
    rows = [rows[i] for i in order]
    lengths = np.array([len(x) for x in rows])
    first = np.cumsum(lengths) - lengths
    word = np.concatenate(rows)
    code = menu.places(word)
    short = code < FREQUENT
    base = np.zeros(len(word))
    base[short] = np.log10((menu.counts[code[short]] + ADDED) / floor)
    kept = [ids[i] for i in order]
    yield home_of_chunk(chunk, blocks), "rows", chunk, pack(
        np.array([x or 0 for x in kept], dtype=np.int64),
        np.array([x is None for x in kept]),
        held[order],
        narrow(lengths),
        np.add.reduceat(base, first),
        narrow(np.add.reduceat(short.astype(np.int64), first)),
    )
    before, before_code = np.roll(word, 1), np.roll(code, 1)
    before[first], before_code[first] = end(), menu.places(end())
    local = np.repeat(np.arange(len(rows)), lengths)
    block = home(before, blocks)
    split = before_code < SPLIT
    block[split] = home(before[split] * np.uint64(0x9E3779B97F4A7C15) + word[split], blocks)
    by = np.argsort(before, kind="stable")
    by = by[np.argsort(narrow(block[by]), kind="stable")]
    bounds = np.searchsorted(block[by], np.arange(blocks + 1))
    n_train = np.array([(~held).sum()])
    for b in np.flatnonzero(np.diff(bounds)):
        at = by[bounds[b] : bounds[b + 1]]
        context = before[at]
        starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        runs = np.diff(np.append(starts, len(at)))
        room, dish = before_code[at[starts]], code[at]
        rare = context[starts][room == FREQUENT], word[at][dish == FREQUENT]
        yield int(b), "text", chunk, pack(room, rare[0], narrow(runs), dish, rare[1], narrow(local[at]), n_train)


def _distinct(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the place of each value; the parts are taken out of their list."""
    values = np.concatenate(parts)
    parts.clear()
    order = np.argsort(values)
    values = values[order]
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    place = np.empty(len(values), dtype=np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return values[new], place


class Block:
    """What a block counted: its contexts and words, the pairs of both with their training counts, and each occurrence's pair and row.

    `strong` pairs occur more than once in training; all others keep the tables they have. `order` has the words by bucket, in each
    bucket those of strong pairs first; `bounds` and `strong_bounds` are the buckets' places in it, among all and among strong words.
    """

    def __init__(self, texts: list[tuple[int, bytes]], menu: Menu, buckets: int):
        contexts, words, rows, train, self.chunks, start = [], [], [], [], [], 0
        for chunk, body in sorted(texts):
            room, rare_rooms, runs, dish, rare, local, n_train = unpack(body)
            contexts.append(np.repeat(menu.spell(room, rare_rooms), runs))
            words.append(menu.spell(dish, rare))
            rows.append(local.astype(np.int32) + np.int32(start))
            train.append(local < n_train[0])
            self.chunks.append((chunk, start))
            start += int(local.max()) + 1
        self.n_rows, self.row, train = start, np.concatenate(rows), np.concatenate(train)
        self.rooms, room = _distinct(contexts)
        self.words, word = _distinct(words)
        pairs, self.pair = _distinct([room.astype(np.int64) * len(self.words) + word])
        del room, word, rows
        self.room, self.word = (x.astype(np.int32) for x in np.divmod(pairs, len(self.words)))
        self.n = np.bincount(self.pair[train], minlength=len(pairs))
        self.split = np.minimum(menu.places(self.rooms), SPLIT).astype(np.int64)
        self.weak = np.bincount(self.room[self.n == 1], minlength=len(self.rooms))
        self.strong = self.n > 1
        strong_word = np.zeros(len(self.words), dtype=bool)
        strong_word[self.word[self.strong]] = True
        bucket = home(self.words, buckets)
        self.order = np.lexsort((~strong_word, bucket))
        self.bounds = np.searchsorted(bucket[self.order], np.arange(buckets + 1))
        self.strong_order = self.order[strong_word[self.order]]
        self.strong_bounds = np.searchsorted(bucket[self.strong_order], np.arange(buckets + 1))

    def split_tables(self, per_room: np.ndarray) -> np.ndarray:
        return np.bincount(self.split, weights=per_room, minlength=SPLIT + 1)[:SPLIT].astype(np.int64)


def _lists(me: int, values: list, menu: Menu, buckets: int) -> Iterator[tuple]:
    """To itself what a block's seating needs; to each bucket the words it shares with the block."""
    texts = [(source, body) for kind, source, body in values if kind == "text"]
    if not texts:
        return
    block = Block(texts, menu, buckets)
    place = np.zeros(len(block.words), dtype=np.int64)
    place[block.strong_order] = np.arange(len(block.strong_order))
    strong_rooms, room = np.unique(block.room[block.strong], return_inverse=True)
    split_weak = block.split_tables(block.weak)
    yield me, ("base", me, pack(
        narrow(place[block.word[block.strong]]),
        narrow(room),
        narrow(block.n[block.strong]),
        narrow(block.weak[strong_rooms]),
        narrow(block.split[strong_rooms]),
        narrow(block.strong_bounds),
        narrow(split_weak),
        np.array([(block.n == 1).sum(), (block.n == 2).sum()]),
    ))
    size = len(block.words)
    n = np.bincount(block.word, weights=block.n, minlength=size).astype(np.int64)[block.order]
    alone = np.bincount(block.word[block.n == 1], minlength=size)[block.order]
    more = np.bincount(block.word[block.strong], minlength=size)[block.order]
    split_tables = narrow(block.split_tables(np.bincount(block.room[block.n > 0], minlength=len(block.rooms))))
    words, strong = block.words[block.order], np.diff(block.strong_bounds)
    for q in range(buckets):
        at = slice(block.bounds[q], block.bounds[q + 1])
        yield q, ("list", me, pack(words[at], narrow(n[at]), narrow(alone[at]), narrow(more[at]), strong[q : q + 1], split_tables))


@dataclass(frozen=True)
class Model:
    """What all know: the discounts of contexts and of the parent, the base of a known word, the numbers of words and of buckets."""

    upper: float
    lower: float
    base: float
    distinct: int
    buckets: int

    def rng(self, *key: int) -> np.random.Generator:
        return np.random.default_rng((1, *key))

    def parent(self, customers: np.ndarray, tables: np.ndarray, all_customers: float, all_tables: float) -> np.ndarray:
        """The parent's predictive probability of words; one without customers stands for all never seen."""
        opens = STRENGTH + self.lower * all_tables
        seen = customers - self.lower * tables + opens * self.base
        return np.where(customers > 0, seen, opens * (1 - SEEN)) / (STRENGTH + all_customers)


def _of(values: list, kind: str) -> list[tuple[int, bytes]]:
    return sorted((source, body) for k, source, body in values if k == kind)


def _buckets(me: int, values: list, model: Model) -> Iterator[tuple]:
    """A bucket's words, from the lists of the blocks, and its first sweep."""
    found = [(source, *unpack(body)) for source, body in _of(values, "list")]
    if not found:
        return
    sources, words, n, alone, more, strong, split = zip(*found)
    words, at = np.unique(np.concatenate(words), return_inverse=True)
    total = lambda parts: np.bincount(at, weights=np.concatenate(parts), minlength=len(words)).astype(np.int64)
    n, fixed, more = total(n), total(alone), total(more)
    sizes, strong = np.array([len(x[1]) for x in found]), np.concatenate(strong)
    yield me, ("bucket", me, pack(np.array(sources), sizes, strong, narrow(at), narrow(n), narrow(fixed)))
    split = np.sum([x.astype(np.int64) for x in split], axis=0)
    customers = fixed + more
    none = np.zeros((len(words), 0), dtype=np.int64)
    yield from _seat_parent(me, model, 0, (sources, sizes, strong, at), customers, (customers > 0).astype(float), model.distinct, split, (none, none, split[:0].reshape(0, SPLIT)))


def _shares(sizes: np.ndarray, strong: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Of each block's words, which come one block after the other, the strong ones."""
    starts = np.cumsum(sizes) - sizes
    return [at[a : a + k] for a, k in zip(starts, strong)]


def _seat_parent(me, model, sweep, bucket, customers, tables, all_tables, split, history) -> Iterator[tuple]:
    """Seats the bucket's words; sends each block the customers and tables of its words of strong pairs."""
    sources, sizes, strong, at = bucket
    mass = (STRENGTH + model.lower * (all_tables - tables)) * model.base
    tables = seat(customers, mass, model.lower, model.rng(sweep, 0, me), model.base)
    past, past_tables, past_split = history
    if sweep >= BURN_IN:
        past = np.column_stack([past, customers])
        past_tables = np.column_stack([past_tables, tables.astype(np.int64)])
    yield me, (f"words{sweep}", me, pack(narrow(tables), _narrow_all(past), _narrow_all(past_tables), past_split))
    sums = np.array([customers.sum(), tables.sum()], dtype=np.int64)
    for p, share in zip(sources, _shares(sizes, strong, at)):
        yield int(p), ("down", me, pack(narrow(customers[share]), narrow(tables[share]), sums, split if p % model.buckets == me else split[:0]))


def _narrow_all(values: np.ndarray) -> np.ndarray:
    return narrow(values.ravel()).reshape(values.shape)


def _parent(me: int, values: list, model: Model, sweep: int) -> Iterator[tuple]:
    """A sweep over a bucket's words; after the last one, what the samples found goes to the blocks."""
    bucket = _of(values, "bucket")
    if not bucket:
        return
    sources, sizes, strong, at, n, fixed = unpack(bucket[0][1])
    tables, past, past_tables, past_split = unpack(_of(values, f"words{sweep - 1}")[0][1])
    ups = [unpack(body) for _, body in _of(values, "up")]
    split = np.sum([x[1].astype(np.int64) for x in ups], axis=0)
    if sweep > BURN_IN:
        past_split = np.concatenate([past_split, split[None]])
    if sweep < BURN_IN + SAMPLES:
        which = np.concatenate(_shares(sizes, strong, at))
        seated = np.bincount(which, weights=np.concatenate([x[0] for x in ups]), minlength=len(n))
        customers = fixed + seated.astype(np.int64)
        history = past, past_tables, past_split
        yield from _seat_parent(me, model, sweep, (sources, sizes, strong, at), customers, tables.astype(float), float(ups[0][2][0]), split, history)
        return
    sums = np.array([past.sum(axis=0, dtype=np.int64), past_tables.sum(axis=0, dtype=np.int64)])
    for p, share in zip(sources, _shares(sizes, sizes, at)):
        yield int(p), ("last", me, pack(narrow(n[share]), past[share], past_tables[share], sums, past_split if p % model.buckets == me else past_split[:0]))


def _children(me: int, values: list, model: Model, sweep: int) -> Iterator[tuple]:
    """A sweep over a block's restaurants; sends each bucket the tables of its words of strong pairs."""
    base = _of(values, "base")
    if not base:
        return
    word, room, n, weak, split, bounds, split_weak, _ = unpack(base[0][1])
    bounds = bounds.astype(np.int64)
    if sweep:
        tables, total, past = unpack(_of(values, "tables")[0][1])
    else:
        tables, total, past = np.ones(len(n)), np.zeros(len(n), dtype=np.int64), np.zeros((len(weak), 0), dtype=np.int64)
    downs = [(source, *unpack(body)) for source, body in _of(values, "down")]
    all_customers, all_tables = np.sum([x[3] for x in downs], axis=0)
    parent = model.parent(np.concatenate([x[1] for x in downs]), np.concatenate([x[2] for x in downs]), all_customers, all_tables)[word]
    everywhere = next(x[4] for x in downs if x[0] == me % model.buckets)
    per_room = weak + np.bincount(room, weights=tables, minlength=len(weak))
    per_room = np.where(split < SPLIT, np.append(everywhere, 0)[split], per_room)
    mass = (STRENGTH + model.upper * (per_room[room] - tables)) * parent
    tables = seat(n.astype(np.int64), mass, model.upper, model.rng(sweep, 1, me), parent).astype(np.int64)
    seated = np.bincount(room, weights=tables, minlength=len(weak)).astype(np.int64)
    if sweep >= BURN_IN:
        total, past = total + tables, np.column_stack([past, weak + seated])
    yield me, ("tables", me, pack(narrow(tables), narrow(total), _narrow_all(past)))
    of_words = np.bincount(word, weights=tables, minlength=bounds[-1]).astype(np.int64)
    of_split = narrow(split_weak + np.bincount(split, weights=seated, minlength=SPLIT + 1)[:SPLIT].astype(np.int64))
    for q in range(len(bounds) - 1):
        yield q, ("up", me, pack(narrow(of_words[bounds[q] : bounds[q + 1]]), of_split, np.array([all_tables], dtype=np.int64)))


def _score(me: int, values: list, menu: Menu, model: Model, floor: float, blocks: int) -> Iterator[tuple]:
    """To the home of each chunk, the sums over a block's occurrences by row."""
    for kind, chunk, body in values:
        if kind == "rows":
            yield me, ("rows", chunk, body)
    texts = [(source, body) for kind, source, body in values if kind == "text"]
    if not texts:
        return
    block = Block(texts, menu, model.buckets)
    lasts = [(source, *unpack(body)) for source, body in _of(values, "last")]
    _, total, past = unpack(_of(values, "tables")[0][1])
    n_word = np.empty(len(block.words), dtype=np.int64)
    n_word[block.order] = np.concatenate([x[1] for x in lasts])
    sums = np.sum([x[4] for x in lasts], axis=0)
    past_split = next(x[5] for x in lasts if x[0] == me % model.buckets)
    tables = (block.n > 0).astype(float)
    tables[block.strong] = total / SAMPLES
    strong_rooms = np.unique(block.room[block.strong])
    is_split = block.split < SPLIT
    opened = np.zeros(len(block.n))
    for k in range(SAMPLES):
        per_room = block.weak.copy()
        per_room[strong_rooms] = past[:, k]
        per_room[is_split] = past_split[k][block.split[is_split]]
        parent = np.empty(len(block.words))
        parent[block.order] = model.parent(np.concatenate([x[2][:, k] for x in lasts]), np.concatenate([x[3][:, k] for x in lasts]), *sums[:, k])
        opened += (STRENGTH + model.upper * per_room)[block.room] * parent[block.word]
    per_room = np.bincount(block.room, weights=block.n, minlength=len(block.rooms))
    per_room[is_split] = menu.counts[block.split[is_split]]
    found = np.log10((block.n - model.upper * tables + opened / SAMPLES) / (STRENGTH + per_room[block.room]))
    scores = np.bincount(block.row, weights=found[block.pair], minlength=block.n_rows)
    touched = np.bincount(block.row, minlength=block.n_rows) > 0
    # The base score of frequent words was added where the rows were read.
    rare = (menu.places(block.words) == FREQUENT)[block.word][block.pair]
    row, word = block.row[rare], block.word[block.pair[rare]]
    base = np.bincount(row, weights=np.log10((n_word + ADDED) / floor)[word], minlength=block.n_rows)
    known = np.bincount(row, weights=(n_word > 0)[word], minlength=block.n_rows).astype(np.int64)
    has_rare = np.bincount(row, minlength=block.n_rows) > 0
    for (chunk, start), end in zip(block.chunks, [*(x for _, x in block.chunks[1:]), block.n_rows]):
        at, rare_at = start + np.flatnonzero(touched[start:end]), start + np.flatnonzero(has_rare[start:end])
        parts = narrow(at - start), scores[at].astype(np.float32), narrow(rare_at - start), base[rare_at], narrow(known[rare_at])
        yield home_of_chunk(chunk, blocks), ("part", (chunk, me), pack(*parts))


def _rows(records: Iterable[tuple], train_tokens: int) -> Iterator[tuple]:
    parts, rows = defaultdict(list), {}
    for _, (kind, source, body) in records:
        if kind == "rows":
            rows[source] = body
        else:
            parts[source[0]].append((source[1], body))
    for chunk, body in rows.items():
        ids, null, held, lengths, base, known = unpack(body)
        score, known = np.zeros(len(ids)), known.astype(np.int64)
        for _, part in sorted(parts[chunk]):
            at, some, rare_at, rare_base, rare_known = unpack(part)
            score[at] += some
            base[rare_at] += rare_base
            known[rare_at] += rare_known
        each = (x.tolist() for x in (ids, null, held, lengths, known, base, score))
        yield from ((None if no else i, h, n, k, train_tokens, b, s) for i, no, h, n, k, b, s in zip(*each))


def _own(key: int) -> int:
    return key


def _step(inputs: list[RDD], blocks: int, work, *given) -> RDD:
    """Does the work on what each block or bucket holds and deals what it sends by its keys."""
    held = inputs[0]
    for more in inputs[1:]:
        held = held.union(more)

    def run(records: Iterable[tuple]) -> Iterator[tuple]:
        by = defaultdict(list)
        for key, value in records:
            by[key].append(value)
        for me in sorted(by):
            yield from work(me, by.pop(me), *given)

    return held.mapPartitions(run).partitionBy(blocks, _own)


def report(documents: DataFrame, block_tokens: int = BLOCK, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document."""
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    words = materialise(rows.mapInArrow(_count, COUNTS).groupBy("word").agg(F.sum("n").alias("n")), "words")
    sizes = words.groupBy("n").agg(F.count(F.lit(1)).alias("m")).sort(F.desc("n")).toArrow()
    n, m = (sizes[c].to_numpy().astype(np.int64) for c in ("n", "m"))
    total, distinct = int((n * m).sum()), int(m.sum())
    # Of equally frequent words all have short codes or none.
    least = n[np.cumsum(m) <= frequent][-1:]
    top = words.filter(F.col("n") >= int(least[0])).collect() if len(least) else []
    menu = make_menu(sorted(((r.word, r.n) for r in top), key=lambda x: (-x[1], x[0])))
    floor = total + ADDED * (distinct + 1)
    blocks = total // block_tokens + 1
    buckets = blocks // SHARED + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = TaskContext.get().partitionId() << 33
        for k, (ids, part) in enumerate(_chunks(batches, False)):
            for block, kind, chunk, body in _deal(own + k, ids, part, menu, floor, blocks):
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "kind": [kind], "chunk": [chunk], "body": pa.array([body], pa.binary())})

    texts = rows.mapInArrow(deal, DEALT).rdd.map(lambda r: (r[0], (r[1], r[2], bytes(r[3])))).partitionBy(blocks, _own)
    lists = _step([texts], blocks, _lists, menu, buckets)
    once = lists.filter(lambda r: r[1][0] == "base").map(lambda r: unpack(r[1][2])[-1].tolist()).collect()
    single, double = np.sum(once, axis=0) if once else (0, 0)
    upper, lower = discount_of(np.array([1, 2]), np.array([single, double])), discount_of(n, m)
    model = Model(upper, lower, SEEN / max(distinct, 1), distinct, buckets)

    parent = down = _step([lists], blocks, _buckets, model)
    up = [_step([lists, down], blocks, _children, model, 0)]
    kept = []
    for sweep in range(1, BURN_IN + SAMPLES):
        down = _step([parent, *kept, *up], blocks, _parent, model, sweep)
        kept, up = [down], [_step([lists, *up, down], blocks, _children, model, sweep)]
    last = _step([parent, *kept, *up], blocks, _parent, model, BURN_IN + SAMPLES)
    parts = _step([texts, *up, last], blocks, _score, menu, model, floor, blocks)
    found = parts.mapPartitions(lambda records: _rows(records, total))
    return materialise(spark.createDataFrame(found, SCORES, verifySchema=False), "scored")


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity per token of held-out and training documents, by the model and by the base score."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(per("score").alias("perplexity"), per("base_score").alias("base_perplexity"))
