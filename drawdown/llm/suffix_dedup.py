"""Removal of byte strings that stand earlier in the corpus, by sorted suffixes.

A byte goes if a string of `LENGTH` bytes that covers it also starts earlier: in a document of smaller id, or in the same one at
an earlier place. What has to be sorted is every suffix by its first `LENGTH` bytes. Most suffixes need not travel:

1. Suffixes are anchored. The anchor of a suffix is the place of the least hash among the `LEAD`-byte strings inside its first
   `LENGTH` bytes. Equal strings have equal anchors at the same distance, and neighbouring suffixes share theirs, so that a
   text falls into runs of about 35 suffixes with one anchor. A run is the bytes from its first suffix to the end of its last.
2. Runs meet by their anchor's leading bytes. Of equal runs all but the first are covered as a whole. Equal runs of one task are
   settled before the shuffle, so a string that fills a third of the corpus arrives once per task.
3. Runs that share the anchor's leading bytes with a different run are where copies begin and end. Only their suffixes are
   sorted: range-partitioned by leading bytes with sampled splitters, which puts all suffixes that could be equal into one
   partition and leaves none to compare across its ends, and sorted there by multikey quicksort, eight bytes at a time.

The covered stretches are gathered per document and cut out of its text.

Defined results: null texts are empty; texts under `LENGTH` bytes stay; documents with a null id come last. Rows that share an id
count as one place in the order: strings they have at the same offset are not earlier than one another, and what is covered in
one of them is cut from each as far as it reaches. Extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawdown.llm.common import ship, whole
from drawdown.session import materialise

LENGTH, LEAD = 100, 32
SPREAD = LENGTH - LEAD + 1
#: Bytes of text whose runs are found at once, runs per shuffle partition, open runs sorted at once.
CHUNK, PER_PART, SORTED = 1_500_000, 1_000_000, 10_000
#: A run travels as its number of suffixes plus this times its anchor's distance from the first.
SHIFT = 1024
NO_ID = 9223372036854775807
RUNS = "lead BIGINT, body BIGINT, doc BIGINT, start BIGINT, size INT"
SPANS = "doc BIGINT, start BIGINT, size INT, open BOOLEAN"
RESULT = "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _lead_hashes(letters: np.ndarray) -> np.ndarray:
    """Hash of the LEAD bytes from each place on, by doubling."""
    out, width, power = letters, 1, _BASE
    while width < LEAD:
        out = out[:-width] * power + out[width:]
        power = power * power
        width *= 2
    return _mix(out)


def _sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    out, have = x, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lead hash, body hash, number of the text, first place in `data` and size (with the anchor, see SHIFT) of each run.

    `data` are the bytes of several texts one behind another, `ends` where each of them ends.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    with np.errstate(over="ignore"):
        letters = _TABLE[data]
        leads = _lead_hashes(letters)
        # The hash decides, then the earlier place.
        ranked = (leads & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(leads), dtype=np.uint64)
        anchors = (_sliding_minimum(ranked, SPREAD) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        place = np.arange(len(anchors))
        text = np.searchsorted(ends, place, side="right")
        inside = place + LENGTH <= ends[np.minimum(text, len(ends) - 1)]
        place, text, anchors = place[inside], text[inside], anchors[inside]
        if not len(place):
            return none.view(np.uint64), none.view(np.uint64), none, none, none
        new = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])])
        at = np.flatnonzero(new)
        first, owner, anchor = place[at], text[at], anchors[at]
        size = np.diff(np.concatenate([at, [len(place)]]))
        # Sums of letters times falling powers: the difference of two, moved back, is the hash of what stands between.
        falling = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data) - 1, _BACK)]), dtype=np.uint64)
        rising = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data) - 1, _BASE)]), dtype=np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(letters * falling, dtype=np.uint64)])
        body = (sums[first + size + LENGTH - 1] - sums[first]) * rising[first]
        # Where the anchor stands in it, and how long it is, belong to a run.
        body = _mix(body + (anchor - first).astype(np.uint64) * _BASE + size.astype(np.uint64) * _BACK)
        return leads[anchor], body, owner, first, size + SHIFT * (anchor - first)


def _merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of each document joined where they overlap or touch."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    if not len(doc):
        return doc, start, stop
    # Shift documents apart so that one running maximum serves all.
    number = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])])
    gap = int(stop.max()) + 2
    reach = np.maximum.accumulate(stop + number * gap)
    new = np.concatenate([[True], start[1:] + number[1:] * gap > reach[:-1]])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(doc)]]) - 1
    return doc[at], start[at], reach[last] - number[last] * gap


def _batch(names_types: str, columns: list) -> pa.RecordBatch:
    kinds = {"BIGINT": pa.int64(), "INT": pa.int32(), "BOOLEAN": pa.bool_(), "BINARY": pa.binary()}
    parts = [x.split() for x in names_types.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, parts)], [n for n, _ in parts])


def _find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs whose equals are not in the same chunk at an earlier place; what those cover as rows without lead."""

    def chunk(ids: list, texts: list) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        ends = np.cumsum([len(x) for x in texts])
        lead, body, owner, first, size = runs(data, ends)
        doc = np.array(ids, dtype=np.int64)[owner]
        start = first - np.concatenate([[0], ends[:-1]])[owner]
        lead, body = lead.view(np.int64), body.view(np.int64)
        order = np.lexsort((start, doc, body, lead))
        lead, body, doc, start, size = lead[order], body[order], doc[order], start[order], size[order]
        again = np.concatenate([[False], (lead[1:] == lead[:-1]) & (body[1:] == body[:-1])]) if len(lead) else np.zeros(0, bool)
        # The place of the first of equals; rows of the same id at the same place are not earlier.
        head = np.maximum.accumulate(np.where(again, 0, np.arange(len(lead))))
        later = (doc != doc[head]) | (start != start[head])
        yield _batch(RUNS, [lead[~again], body[~again], doc[~again], start[~again], size[~again]])
        d, s, e = _merged(doc[later], start[later], start[later] + size[later] % SHIFT + LENGTH - 1)
        yield _batch(RUNS, [[None] * len(d), [None] * len(d), d, s, e - s])

    ids, texts, held = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            if len(raw) >= LENGTH:
                ids.append(doc)
                texts.append(raw)
                held += len(raw)
            if held > CHUNK:
                yield from chunk(ids, texts)
                ids, texts, held = [], [], 0
    if ids:
        yield from chunk(ids, texts)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered stretches, and open runs: the first of their kind that share a lead with a different run."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    settled = table.filter(pa.compute.is_null(table["lead"]))
    yield _batch(SPANS, [settled["doc"].to_numpy(), settled["start"].to_numpy(), settled["size"].to_numpy(), np.zeros(len(settled), bool)])
    table = table.filter(pa.compute.is_valid(table["lead"]))
    lead, body, doc, start, size = (table[x].to_numpy() for x in ("lead", "body", "doc", "start", "size"))
    if not len(lead):
        return
    order = np.lexsort((start, doc, body, lead))
    lead, body, doc, start, size = lead[order], body[order], doc[order], start[order], size[order]
    new_lead = np.concatenate([[True], lead[1:] != lead[:-1]])
    fresh = new_lead | np.concatenate([[True], body[1:] != body[:-1]])
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(lead)), 0))
    later = (doc != doc[head]) | (start != start[head])
    kinds = np.bincount(np.cumsum(new_lead) - 1, weights=fresh)[np.cumsum(new_lead) - 1]
    opened = ~later & fresh & (kinds > 1)
    d, s, e = _merged(doc[later], start[later], start[later] + size[later] % SHIFT + LENGTH - 1)
    yield _batch(SPANS, [d, s, e - s, np.zeros(len(d), bool)])
    yield _batch(SPANS, [doc[opened], start[opened], size[opened], np.ones(opened.sum(), bool)])


OPEN = "lead BINARY, body BINARY, doc BIGINT, start BIGINT, size INT"


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each open run of a text."""
    for batch in batches:
        out = []
        for doc, text, starts, sizes in zip(*[batch.column(k).to_pylist() for k in range(4)]):
            raw = (text or "").encode("utf-8", "surrogatepass")
            for start, size in zip(starts, sizes):
                anchor, size = divmod(size, SHIFT)
                piece = raw[start : start + size + LENGTH - 1]
                if len(piece) == size + LENGTH - 1:
                    out.append((piece[anchor : anchor + LEAD], piece, doc, start, size))
        yield _batch(OPEN, list(zip(*out)) or [[]] * 5)


def multikey_order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal rows of bytes together, and the number of each row's class.

    Multikey quicksort with eight bytes as a character: rows that are alone with what was read so far are done, the others are
    sorted by their next eight bytes.
    """
    words = rows.view(">u8").astype(np.uint64)
    group, active = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
    for depth in range(words.shape[1]):
        order = np.lexsort((words[active, depth], group[active]))
        active = active[order]
        here, word = group[active], words[active, depth]
        new = np.concatenate([[True], (here[1:] != here[:-1]) | (word[1:] != word[:-1])]) if len(active) else np.zeros(0, bool)
        number = np.cumsum(new) - 1
        group[active] = number + group.max(initial=0) + 1
        active = active[np.bincount(number)[number] > 1] if len(active) else active
        if not len(active):
            break
    return np.argsort(group, kind="stable"), group


def _sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches covered by suffixes that stand earlier, from the open runs of a range of leads."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held).sort_by("lead")
    leads = table["lead"].to_pylist()
    begin = 0
    while begin < len(leads):
        stop = min(begin + SORTED, len(leads))
        while stop < len(leads) and leads[stop] == leads[stop - 1]:
            stop += 1
        part = table.slice(begin, stop - begin)
        begin = stop
        size, bodies = part["size"].to_numpy(), part["body"].to_pylist()
        joined = np.frombuffer(b"".join(bodies), dtype=np.uint8)
        base = np.concatenate([[0], np.cumsum([len(x) for x in bodies])[:-1]])
        run = np.repeat(np.arange(len(size)), size)
        within = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
        rows = np.zeros((len(run), -(-LENGTH // 8) * 8), dtype=np.uint8)
        rows[:, :LENGTH] = np.lib.stride_tricks.sliding_window_view(joined, LENGTH)[base[run] + within]
        _, kind = multikey_order(rows)
        doc, start = part["doc"].to_numpy()[run], part["start"].to_numpy()[run] + within
        order = np.lexsort((start, doc, kind))
        kind, doc, start = kind[order], doc[order], start[order]
        head = np.maximum.accumulate(np.where(np.concatenate([[True], kind[1:] != kind[:-1]]), np.arange(len(kind)), 0))
        later = (doc != doc[head]) | (start != start[head])
        d, s, e = _merged(doc[later], start[later], start[later] + LENGTH)
        yield _batch(SPANS, [d, s, e - s, np.zeros(len(d), bool)])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = [x.split()[0] for x in RESULT.split(", ")]
    for batch in batches:
        out = []
        for doc, text, starts, stops in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3)):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            kept, at, removed, spans = hashlib.sha256(), 0, 0, 0
            starts, stops = (np.array(x.as_py() or [], dtype=np.int64) for x in (starts, stops))
            for start, stop in zip(*(x.tolist() for x in _merged(np.zeros(len(starts), np.int64), starts, stops)[1:])):
                start, stop = min(start, len(raw)), min(stop, len(raw))
                if start < stop:
                    kept.update(raw[at:start])
                    at, removed, spans = stop, removed + stop - start, spans + 1
            kept.update(raw[at:])
            out.append((doc, len(raw), removed, spans, kept.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, kinds)], names)


def spans(documents: DataFrame) -> DataFrame:
    """doc (id, null as the largest number), start, size of stretches covered by earlier strings; they may overlap."""
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.col("text"))
    found = rows.mapInArrow(_find_runs, RUNS)
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-volume // (35 * PER_PART)), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # What is settled already goes anywhere.
    settled = materialise(
        found.repartition(parts, F.coalesce("lead", F.xxhash64("doc", "start"))).mapInArrow(_settle, SPANS), "suffix-runs"
    )
    opened = settled.filter("open").groupBy("doc").agg(F.collect_list(F.struct("start", "size")).alias("runs"))
    pieces = rows.join(opened, "doc").select("doc", "text", "runs.start", "runs.size").mapInArrow(_fetch, OPEN)
    sorted_ = pieces.repartitionByRange(parts, "lead").mapInArrow(_sort_suffixes, SPANS)
    return settled.filter("NOT open").unionByName(sorted_).select("doc", "start", "size")


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    covered = spans(documents).groupBy("doc").agg(
        F.collect_list(F.struct("start", (F.col("start") + F.col("size")).alias("stop"))).alias("cut")
    )
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.col("text"))
    joined = rows.join(covered, "doc", "left").select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "text", "cut.start", "cut.stop")
    return joined.mapInArrow(_cut, RESULT)
