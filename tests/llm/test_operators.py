"""Small tables against brute force, and the cases each operator defines a result for."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from drawdown.llm import (
    bagminhash,
    chat,
    decontaminate,
    hpy_lm,
    langid,
    line_dedup,
    packing,
    quality_rules,
    suffix_dedup,
    token_store,
)
from drawdown.llm.encoding import encoder, public_path

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, _words STRING, hash LONG"
WORD, BYTE = public_path("word_bpe_49k.json"), public_path("byte_bpe_50k.json")


def words(rng, n):
    return " ".join("".join(rng.choice("abdeilnorst") for _ in range(rng.randint(2, 8))) for _ in range(n))


def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows and columns with clashing names."""
    rng = random.Random(5)
    long_text = words(rng, 30000)
    base = words(rng, 80)
    rows = [(i, t) for i, t in enumerate(
        [None, "", " \n\t ", "one", base, base, base + " more", long_text, long_text[: len(long_text) // 2], "É ß ñ\n" * 40,
         "<|endoftext|> </s> \x01 'll  x", "a a a a a a a a a a a a a a a a a a a a"])]
    rows += [rows[4], (None, base), (None, None), (7, "other text under the same id")]
    return spark.createDataFrame([(i, t, "en" if t else None, None, None, "w", 1) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def everything(spark, docs):
    labels = spark.createDataFrame([(4, 1, 0), (None, None, None), (4, 0, 0)], "doc_id LONG, quality INT, toxic INT")
    bench = spark.createDataFrame([(1, "one"), (None, "x"), (2, None), (3, "")], "item_id LONG, text STRING")
    return {
        "op1": lambda: quality_rules.report(docs, labels),
        "op2": lambda: hpy_lm.report(docs),
        "op3": lambda: line_dedup.report(docs),
        "op4": lambda: suffix_dedup.report(docs),
        "op5": lambda: bagminhash.report(docs),
        "op6": lambda: token_store.report(docs, WORD, "word", 2),
        "op7": lambda: packing.pack(docs, BYTE, "byte", 0),
        "op8": lambda: decontaminate.report(docs, bench),
        "op10": lambda: langid.report(docs),
        "keep": lambda: quality_rules.keep(docs, labels),
        "lines": lambda: line_dedup.dedup(docs),
        "near": lambda: bagminhash.dedup(docs),
        "clean": lambda: decontaminate.clean(docs, bench),
    }


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op10", "keep", "lines", "near", "clean"])
def test_odd_and_empty_tables(spark, name):
    odd = odd_docs(spark)
    found = everything(spark, odd)[name]()
    rows = found.count()
    per_row = {"op1": 16, "op2": 16, "op4": 16, "op6": 16, "op8": 15, "op10": 16, "lines": 16}
    assert rows == per_row.get(name, rows) and (rows > 0 or name == "keep")
    assert everything(spark, odd.limit(0))[name]().count() == 0


def test_repeated_windows_and_base(spark):
    texts = ["a b c d e f g h i j", "x a b c d e y a b c d e z q", "p p p p p p p p", "k\nk\n \n#k $\nk", None]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id LONG, text STRING, lang STRING")
    got = {r.doc_id: r for r in quality_rules.with_features(df).collect()}
    for i, text in enumerate(texts):
        w = (text or "").split()
        grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        hit = {k + d for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for d in range(5)}
        lines = [x for x in (text or "").split("\n") if x.split()]
        assert (got[i].n_words, got[i].word_chars, got[i].n_repeat_words) == (len(w), sum(map(len, w)), len(hit))
        assert got[i].n_dup_lines == len(lines) - len(set(lines))
        assert got[i].n_symbols == sum(c in "#*$%&|<>" for c in text or "")


def test_binomial_tail(spark):
    cases = [(0, 500, 0.01), (3, 900, 0.01), (40, 6000, 0.01), (5, 15, 0.4)]
    for k, n, p in cases:
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(quality_rules.binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        assert got == pytest.approx(want, rel=1e-9)


def test_cutoffs_reject_bad_and_keep_good(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, 40) if i % 4 else " ".join(w + "###" for w in words(rng, 40).split()), "en") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(4000)], "doc_id LONG, quality INT, toxic INT")
    kept = {r.doc_id for r in quality_rules.report(df, labels).filter("kept").collect()}
    assert kept == {i for i in range(4000) if i % 4}


def test_language_model_base_and_gain(docs):
    got = {r.doc_id: r for r in hpy_lm.report(docs).collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b""] for r in docs.collect()}
    count = Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10 for w in t)
    total, kinds = sum(count.values()), len(count)
    for i, t in texts.items():
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in t)
        assert got[i].base_score == pytest.approx(base, abs=1e-6)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(t), sum(count[w] > 0 for w in t), total)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_sums_to_one():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 5, (4, 30)) * rng.integers(0, 2, (4, 30))
    assert np.allclose((10 ** hpy_lm.fit_upper(counts)).sum(axis=1), 1)
    by_count, many = np.array([1, 2, 7]), np.array([50.0, 9.0, 3.0])
    each, unseen = hpy_lm.fit_rare(by_count, many)
    assert (10**each * many).sum() + 10**unseen == pytest.approx(1)


def test_language_model_knows_every_context(spark):
    train = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10]
    test = [i for i in range(2000) if not zlib.crc32(str(i).encode()) % 10]
    rows = [(i, f"a{k % 200} b{k % 200}") for k, i in enumerate(train)]
    rows += [(test[0], "a199 b199"), (test[1], "a199 b198"), (test[2], "a3 b3"), (test[3], "a3 b198")]
    got = {r.doc_id: r.score for r in hpy_lm.report(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()}
    assert got[test[0]] > got[test[1]] + 1 and got[test[2]] > got[test[3]] + 1


def test_language_model_against_a_table_in_memory(spark):
    rng = np.random.default_rng(4)
    follows = rng.permutation(180)
    texts = []
    for _ in range(400):
        row = [int(rng.zipf(1.3)) % 180]
        while len(row) < 30:
            row.append(int(follows[row[-1]]) if rng.random() < 0.4 else int(rng.zipf(1.3)) % 180)
        texts.append([f"w{x}" for x in row])
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    texts[held.index(True)][3:5] = ["never", "w0"]
    names = {w: k for k, w in enumerate(sorted({w for t, h in zip(texts, held) if not h for w in t}))}
    size = len(names) + 1  # the last is the end; another row is behind a word never seen, another column such a word
    place = lambda w, i: names.get(w, size)
    pairs = [[*zip([size - 1, *(place(w, i) for w in t)], [*(place(w, i) for w in t), size - 1])] for i, t in enumerate(texts)]
    counts = np.zeros((size + 1, size), dtype=np.int64)
    for row, h in zip(pairs, held):
        for u, w in row if not h else ():
            counts[u, w] += 1
    want = []
    for seed in range(4):
        table = hpy_lm.fit_upper(counts, seed, hpy_lm.SEEN)
        table = np.column_stack([table, np.log10(1 - (10**table).sum(axis=1))])
        want.append([sum(table[u, w] for u, w in row) for row in pairs])
    want, noise = np.mean(want, axis=0), np.std(want, axis=0).max()
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id LONG, text STRING")
    for many in ({}, {"block_tokens": 3000, "frequent": 100}):
        got = {r.doc_id: r for r in hpy_lm.report(df, **many).collect()}
        assert len(got) == len(texts) and all(got[i].held_out == h for i, h in enumerate(held))
        off = np.array([got[i].score for i in range(len(texts))]) - want
        assert noise < 0.5 and np.abs(off).max() < 0.6 and np.abs(off.mean()) < 0.03
        assert got[held.index(True)].n_known == 30


def test_tables_of_a_dish():
    mass, discount, share, customers = 0.7, 0.6, 0.3, 12
    chances = np.zeros(customers + 1)
    chances[1] = 1.0
    for j in range(1, customers):
        t = np.arange(customers + 1)
        opens = mass + discount * share * t
        new = opens / (opens + np.maximum(j - discount * t, 0))
        chances = np.where(t <= j, chances * (1 - new), 0) + np.append(0, (chances * new)[:-1])
    draws = hpy_lm.seat(np.full(40_000, customers), mass, discount, np.random.default_rng(0), share)
    assert np.abs(np.bincount(draws.astype(int), minlength=customers + 1) / 40_000 - chances).max() < 0.012
    two = hpy_lm.seat(np.full(40_000, 2), mass, discount, np.random.default_rng(0), share)
    opens = mass + discount * share
    assert (two == 2).mean() == pytest.approx(opens / (opens + 1 - discount), abs=0.012)
    assert hpy_lm.seat(np.array([0, 1]), mass, discount, np.random.default_rng(0)).tolist() == [0, 1]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_line_links_by_brute_force(spark):
    rng = random.Random(4)
    lines = [words(rng, rng.randint(1, 9)) for _ in range(40)]
    for _ in range(120):
        line = list(rng.choice(lines))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(line))
            line[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "é"])
        lines.append("".join(line))
    df = spark.createDataFrame([(i, "\n".join(lines[4 * i : 4 * i + 4]), 0) for i in range(40)], "doc_id LONG, text STRING, hash INT")
    first = {}
    for n, line in enumerate(lines):
        if line.split():
            first.setdefault(line, n)
    linked = {
        a: [first[b] for b in first if a != b and min(len(a), len(b)) >= 20 and abs(len(a) - len(b)) < 3 and distance(a, b) <= 2]
        for a in first
    }
    got = {4 * r.doc_id + r.line_no: r for r in line_dedup.report(df).collect()}
    assert {k: r.n_links for k, r in got.items()} == {first[a]: len(x) for a, x in linked.items()}
    gone = {a for a in first if any(n < first[a] for n in linked[a])}
    want = ["\n".join(x for n, x in enumerate(lines[4 * i : 4 * i + 4], 4 * i) if not x.split() or (first[x] == n and x not in gone)) for i in range(40)]
    assert [r.text for r in line_dedup.dedup(df).sort("doc_id").collect()] == want


def test_every_line_has_its_class(spark, tmp_path):
    from drawdown.llm import queries

    near = "a line that is long enough to be linked"
    texts = ["one\n" + near, None, near + "s\ntwo\n\none", "one\n" + near, "two"]
    rows = [*enumerate(texts), (None, "two\nlast")]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    names = ("doc_id", "line_no", "class_doc_id", "class_line_no", "n_copies", "n_links", "link_doc_id", "link_line_no", "kept")
    want = {
        (0, 0, 0, 0, 3, 0, None, None, True), (0, 1, 0, 1, 2, 1, 2, 0, True),
        (2, 0, 2, 0, 1, 1, 0, 1, False), (2, 1, 2, 1, 3, 0, None, None, True), (2, 3, 0, 0, 3, 0, None, None, False),
        (3, 0, 0, 0, 3, 0, None, None, False), (3, 1, 0, 1, 2, 1, 2, 0, False),
        (4, 0, 2, 1, 3, 0, None, None, False),
        (None, 0, 2, 1, 3, 0, None, None, False), (None, 1, None, 1, 1, 0, None, None, True),
    }
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op3_line_dedup(spark, str(tmp_path)).select(*names).collect()]
    assert len(got) == len(want) and set(got) == want


def test_removed_bytes_by_brute_force(spark):
    rng = random.Random(6)
    parts = [words(rng, 40) for _ in range(6)] + ["é" * 90, "The " * 60]
    texts = ["".join(rng.choice(parts)[rng.randint(0, 9) :] for _ in range(rng.randint(0, 4))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    got, seen = {r.doc_id: r for r in suffix_dedup.report(df).collect()}, set()
    for i, text in enumerate(texts):
        raw = text.encode()
        gone = [False] * len(raw)
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                gone[k : k + 100] = [True] * 100
            seen.add(raw[k : k + 100])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        assert (got[i].n_removed, got[i].n_spans) == (sum(gone), spans)
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_near_duplicates_that_drift_by_brute_force(spark):
    """Texts that drift from one another word by word, in several threads: buckets hold more than one component."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(400)}" for _ in range(160)]
    texts = []
    for _ in range(6):
        words = list(base)
        for _ in range(14):
            for _ in range(rng.choice((1, 2, 4, 7))):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    bags, label = [bagminhash.bag(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and bagminhash.similarity(bags[i], bags[j]) >= 0.8:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    assert len(set(label)) > 3
    assert {r.doc_id: r.class_id for r in bagminhash.report(df).collect()} == dict(enumerate(label))


def test_agreement_counts_registers_with_equal_low_bytes(spark):
    texts = ["a b c d e f g h i j k l", "a b c d e f g h i j k l m", "n o p q r s t"]
    rows = bagminhash.signatures([bagminhash.bag(t) for t in texts])
    planes = bagminhash.bit_planes(rows).tolist()
    df = spark.createDataFrame([(planes[0], p) for p in planes], "a ARRAY<LONG>, b ARRAY<LONG>")
    got = [r.n for r in df.select(bagminhash.agreement(F.col("a"), F.col("b")).alias("n")).collect()]
    low = rows.astype(np.uint8)
    assert got == [int((low[0] == r).sum()) for r in low]


def test_second_signature_estimates_similarity(spark):
    texts = [" ".join(f"w{k}" for k in range(low, low + 400)) for low in (0, 0, 20, 50, 5000)]
    bags = [bagminhash.bag(t) for t in texts]
    planes = bagminhash.bit_planes(bagminhash.signatures(bags, bagminhash.LONG), 1).tolist()
    df = spark.createDataFrame([(planes[0], p) for p in planes] + [(planes[0], None)], "a ARRAY<LONG>, b ARRAY<LONG>")
    got = [r.n for r in df.select(bagminhash.long_agreement(F.col("a"), F.col("b")).alias("n")).collect()]
    assert got[0] == got[1] == bagminhash.LONG and got[5] is None
    for n, other in zip(got, bags):
        assert abs(2 * n / bagminhash.LONG - 1 - bagminhash.similarity(bags[0], other)) < 0.1


@pytest.mark.parametrize("crowd", [1, 24])
def test_crowded_buckets_by_brute_force(spark, monkeypatch, crowd):
    """Many copies of one text, each changed in some places: most pairs are two thirds alike, some are near-duplicates."""
    monkeypatch.setattr(bagminhash, "CROWD", crowd)
    rng = random.Random(17)
    base = [f"w{k}" for k in range(300)]
    texts = []
    for _ in range(120):
        copy = list(base)
        for at in rng.sample(range(300), rng.choice((1, 3, 4, 5, 6, 7))):
            copy[at] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    bags, label = [bagminhash.bag(t) for t in texts], list(range(len(texts)))
    open_pairs = 0
    for i in range(len(texts)):
        for j in range(i + 1, len(texts)):
            open_pairs += 0.6 < bagminhash.similarity(bags[i], bags[j]) < 0.8
            if label[i] != label[j] and bagminhash.similarity(bags[i], bags[j]) >= 0.8:
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    assert open_pairs > 3000 and len(set(label)) > 3
    assert {r.doc_id: r.class_id for r in bagminhash.report(df).collect()} == dict(enumerate(label))


def test_near_duplicate_classes_by_brute_force(spark):
    rng = random.Random(8)
    texts = [words(rng, rng.randint(20, 120)) for _ in range(15)]
    for _ in range(60):
        w = rng.choice(texts).split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = words(rng, 1)
        texts.append(" ".join(w))
    bags, label = [bagminhash.bag(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and bagminhash.similarity(bags[i], bags[j]) >= 0.8:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    assert {r.doc_id: r.class_id for r in bagminhash.report(df).collect()} == dict(enumerate(label))
    assert {r.doc_id for r in bagminhash.dedup(df).collect()} == set(label)


def test_ids_come_back_exactly(spark, docs):
    from tokenizers import Tokenizer

    odd = [r.text for r in odd_docs(spark).select("text").collect()]
    texts = odd + [r.text for r in docs.collect()]
    for path, kind in ((WORD, "word"), (BYTE, "byte")):
        plain = Tokenizer.from_file(path)
        for text in texts:
            want = plain.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(encoder(path, kind).encode(text), "<u4").tolist() == want


def test_token_store_access_and_starts(spark, docs, tmp_path):
    token_store.write(docs, f"{tmp_path}/s", WORD, "word", 2)
    every = token_store.read(spark, f"{tmp_path}/s").sort("doc_id").collect()
    start = 0
    for r in every:
        assert r.start == start
        start += len(r.ids) // 4
    some = token_store.read(spark, f"{tmp_path}/s", [every[3].doc_id, every[50].doc_id, -5]).sort("doc_id").collect()
    assert some == [every[3], every[50]]


def test_packing_is_whole_and_tight(docs):
    rows = packing.pack(docs, BYTE, "byte", 0, local=50).collect()
    seq = {}
    for r in rows:
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in seq.values():
        assert [o for o, _ in sorted(items)] == list(np.cumsum([0, *[n for _, n in sorted(items)]])[:-1])
        assert sum(n for _, n in items) <= 2048
    assert len(rows) == len({(r.doc_id, r.piece) for r in rows})
    assert len(seq) <= 1.1 * -(-sum(r.length for r in rows) // 2048)


def test_packing_goes_on_while_a_round_joins_bins(spark):
    """Few pieces fit with another one, and those are seldom in one partition: a round joins under 5% of the bins."""
    texts = ["a " * 70] * 800 + ["a " * 40] * 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    rows = packing.pack(df, BYTE, "byte", 0, capacity=100, local=20).collect()
    assert len(rows) == len(texts) == len({r.doc_id for r in rows})
    # One round alone leaves 829; the rounds end when one joins nothing by chance.
    assert 820 <= len({r.sequence_id for r in rows}) <= 827
    used = Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 100


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "a<|end|>\n\\b"), (1, 1, "assistant", "</s>[INST]<s>\\"), (1, 2, "user", None), (2, 0, None, "x"),
            (None, 0, "assistant", ""), (3, 1, "assistant", "b"), (3, 1, "assistant", "b"), (3, None, "sys\ntem", "<|turn|>")]
    df = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")
    got = {r.conv_id: r for r in chat.report(df).collect()}
    want = {1: rows[:3], 2: rows[3:4], None: rows[4:5], 3: [rows[7], rows[5], rows[6]]}
    for conv, turns in want.items():
        said = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        assert (got[conv].n_turns, got[conv].loss_chars) == (len(turns), len(loss))
        assert got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got[-1].n_turns == 2 and chat.examples(df.limit(0)).count() == 0


def test_language_of_held_out_texts(docs):
    rows = langid.report(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_pipeline_stages(spark, sf_dir, docs):
    import corpus_pipeline

    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialise(stage(spark, before, sf_dir), f"test-{name}")
        assert after.columns == docs.columns and 0 < after.count() <= before.count()
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    assert packed.select("doc_id").distinct().count() == before.count()


def test_planted_copies_leave_the_pipeline(spark, sf_dir):
    import corpus_pipeline

    rng = random.Random(12)
    base = ["\n".join(words(rng, 12) for _ in range(5)) for _ in range(4)]
    near = base[2].replace("a", "e", 1)
    planted = [*base, base[0], base[0], base[1].replace("\n", "\n\n"), near, base[3] + "\n" + words(rng, 12), "", None]
    rows = [(i, t, None, None, len(t or ""), None, None) for i, t in enumerate(planted)] + [(None, base[1], None, None, 0, None, None)]
    before = spark.createDataFrame(rows, DOCS)
    for name, stage in corpus_pipeline.STAGES[1:3]:
        before = corpus_pipeline.materialise(stage(spark, before, sf_dir), f"test-{name}")
    assert sorted(r.doc_id for r in before.collect()) == [0, 1, 2, 3, 8, 9, 10]
    packed = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    assert {r.doc_id for r in packed.collect()} == {0, 1, 2, 3, 8, 9, 10}


@pytest.mark.parametrize("name", ["keep", "lines", "near", "clean"])
def test_stages_with_columns_named_as_their_own(spark, name):
    """Names that the stages use inside, in either case, come through with their values."""
    odd = odd_docs(spark)
    clash = ("_ID", "_key", "_out", "_dirty", "n_words", "stratum", "class", "text_key", "line_no", "kept", "_row")
    wide = odd.withColumns({c: F.concat(F.lit(c), F.lit("!")) for c in clash})
    want = sorted(map(str, everything(spark, odd)[name]().collect()))
    got = everything(spark, wide)[name]()
    assert got.columns == wide.columns
    assert got.filter(~(F.col("_ID") == "_ID!")).count() == 0
    assert sorted(map(str, got.select(*odd.columns).collect())) == want


def test_ids_of_control_strings_are_the_library_s(spark):
    from tokenizers import Tokenizer

    rng = random.Random(9)
    atoms = ["<|endoftext|>", "<|startoftext|>", "a", "The", " ", "  ", "\n", "<", "|>", "é", "'s", "."]
    for path, kind in ((WORD, "word"), (BYTE, "byte")):
        plain = Tokenizer.from_file(path)
        for _ in range(500):
            text = "".join(rng.choice(atoms) + rng.choice(["", " "]) for _ in range(rng.randint(1, 8)))
            want = plain.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(encoder(path, kind).encode(text), dtype="<u4").tolist() == want
