import zlib

import numpy as np
import pytest
from brute import DATA, near_classes, odd_rows, prose, read, repeats, table, words

from corpuslens.llm import ngram_join, packing, substrings, token_blocks, tokens, toxicity
from corpuslens.llm.components import components
from corpuslens.llm.queries import LLM_QUERIES
from corpuslens.storage import work_path


def whole_ids(texts):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokens.tokenizer_path()).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [x.ids for x in found]


ODD_TEXTS = ["it's WE'LL i've\u0301 e\u0301 \u0301x", "a\x1cb\x85c\u00a0d\u3000e", "<|endoftext|> x<|startoftext|>y", "ÀÉ Σς İ ﬁ ½ ٣ 漢字かな 😀👍🏽", "\x00 \x7f \ufeff", "3.14e-10 a_b__c ---"]


def test_words_apart_give_whole_ids():
    texts = [None, "", *ODD_TEXTS, *(t for _, t in odd_rows())]
    raw = [t and t.encode() for t in texts]
    got = tokens.encoder(tokens.tokenizer_path()).ids(raw)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == whole_ids(texts)
    assert tokens.encoder(tokens.tokenizer_path(), by_word=False).ids(raw) == got


@pytest.mark.parametrize("high", [1, 2, 50_000, 2**32])
@pytest.mark.parametrize("n", [0, 1, 7, 1024, 5000])
def test_blocks_round_trip(high, n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
    ids[::31] = high - 1
    held = token_blocks.TokenFile(token_blocks._file_bytes([1, None], [n - n // 3, n // 3], ids, 256))
    assert held.doc_ids == [1, None] and (held.ids(0, n) == ids).all()
    for a, b in ((0, n // 2), (n // 3, n), (n, n)):
        assert (held.ids(a, b) == ids[a:b]).all()


def test_blocks_are_smaller_for_small_ranges():
    ids = np.arange(4096, dtype=np.uint32) % 16 + 40_000
    ids[5] = 7
    assert len(b"".join(token_blocks.encode_blocks(ids))) < len(ids)


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_blocks, "FILE_DOCS", 4)
    rows = [*odd_rows(), *((50 + i, t) for i, t in enumerate(ODD_TEXTS)), (None, "no id")]
    folder = work_path(spark, "token-test")
    manifest = token_blocks.write_token_files(table(spark, rows, shard=1, n_ids=2), folder, tokens.tokenizer_path())
    out = sorted(token_blocks.read_token_files(manifest, folder, with_ids=True).collect(), key=lambda r: r.start)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (doc_id, _), ids in zip(out, rows, whole_ids([t for _, t in rows]), strict=True):
        ids = [*ids, 2]
        expected = (doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == expected and r.ids == ids
        at += len(ids)
    assert token_blocks.encode_documents(table(spark, [])).count() == 0


def test_best_fit_respects_every_capacity():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 500)
    for rule in ("norm", "dot"):
        limits = packing.Capacities(tokens=100, documents=5, attention=5000, rule=rule)
        bins, offsets = packing.best_fit(lengths, limits)
        for b in np.unique(bins):
            held = lengths[bins == b]
            alone = len(held) == 1
            assert held.sum() <= 100 and len(held) <= 5 and (alone or (held**2).sum() <= 5000)
            places = np.sort(offsets[bins == b])
            assert places[0] == 0 and (np.diff(places) == held[np.argsort(offsets[bins == b])][:-1]).all()


def check_packing(out, docs, capacity=2048):
    pieces, at = {}, {}
    for (d, _), ids in zip(docs, whole_ids([t for _, t in docs])):
        ids = [*ids, 0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            pieces.setdefault((d, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())), 0)
            pieces[d, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    for r in out:
        pieces[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] -= 1
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert not any(pieces.values())
    for held in at.values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *(n for _, n in held)])[:-1].tolist()
        assert sum(n for _, n in held) <= capacity
    return len(at), -(-sum(r.length for r in out) // capacity)


def test_packing(spark):
    rows = [*odd_rows(), (None, "no id"), (None, "no id")]
    check_packing(packing.pack_documents(table(spark, rows, offset=1, sequence_id=2)).collect(), rows)
    docs = [(r.doc_id, r.text) for r in read(spark, "sf0.01").collect()]
    used, least = check_packing(LLM_QUERIES["op6_packing"](spark, f"{DATA}/sf0.01").collect(), docs)
    assert used <= 1.01 * least
    assert packing.pack_documents(table(spark, [])).count() == 0
    filled = packing.sequences(packing.pack_documents(table(spark, rows[:6]), with_ids=True)).collect()
    assert sum(len(r.ids) // 4 for r in filled) == sum(len(i) + 1 for i in whole_ids([t for _, t in rows[:6]]))


def near_group(n, size=150):
    base = prose(size, 77).split()
    out = []
    for i in range(n):
        w = list(base)
        w[(i * 7) % size], w[(i * 3 + 1) % size] = f"x{i}", f"y{i}"
        out.append((10_000 + i, " ".join(w)))
    return out


@pytest.mark.parametrize("cell", [384, 5])
def test_near_duplicates(spark, monkeypatch, cell):
    monkeypatch.setattr(ngram_join, "CELL_TEXTS", cell)
    rows = [*odd_rows(), *near_group(60)]
    out = ngram_join.near_duplicates(table(spark, rows, bucket=1, cell=2, n=3)).collect()
    expected = sorted((d, c if words(t) else d, n) for (d, t), (_, c, n) in zip(rows, near_classes(rows)))
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in out) == expected


def test_near_duplicates_of_documents(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, "sf0.01").collect()]
    out = LLM_QUERIES["op2_ngram_join"](spark, f"{DATA}/sf0.01").collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in out) == sorted(near_classes(docs))


def test_one_of_each(spark):
    rows = [*odd_rows(), (None, prose(120, 5)), (None, "only here, without an id")]
    kept = ngram_join.one_of_each(table(spark, rows)).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 0, 1, 2, 3, 4, 5, 6, 9, 10, 11, 13]
    assert ngram_join.near_duplicates(table(spark, [])).count() == 0
    assert ngram_join.one_of_each(table(spark, [(1, None), (2, "")])).count() == 2


def test_bands_reach_the_recall():
    for similarity, recall in ((0.8, 0.9999), (0.5, 0.95), (0.95, 0.999)):
        bands, rows = ngram_join.bands_for(similarity, recall)
        assert 1 - (1 - similarity**rows) ** bands >= recall and bands * rows <= ngram_join.HASHES


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 60), (7, 7), (300, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(2, 41), 1), 60: 50, 100: 50}


def test_repeats(spark, monkeypatch):
    passage = prose(45, 3)
    rows = [r for r in dict(odd_rows()).items()] + near_group(30)
    rows += [(20_000 + i, f"{prose(i + 1, i + 40)} {passage} {prose(13, i + 70)}") for i in range(40)]
    rows += [(30_000, " ".join([passage, passage, prose(19, 3)])), (30_001, "a " * 300), (30_002, prose(19, 3))]
    for size in (substrings.SLOT_BYTES, 1 << 12):
        monkeypatch.setattr(substrings, "SLOT_BYTES", size)
        out = substrings.find_repeats(table(spark, rows, places=1, kind=2)).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == repeats(rows)
        assert all(sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_removed for r in out)


def test_repeats_across_slices(spark, monkeypatch):
    docs = [(r.doc_id, r.text) for r in read(spark, "sf0.01").collect()]
    out = substrings.find_repeats(read(spark, "sf0.01").repartition(7)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == repeats(docs)


def test_cut_repeats(spark):
    rows = [(None, prose(60, 5)), (None, prose(60, 5)), (3, "x\n" + prose(60, 5)), (4, "one\n\n" + prose(60, 5) + "\ntwo"), (5, prose(60, 5)), (6, None)]
    out = {r.doc_id: r for r in substrings.cut_repeats(table(spark, rows)).collect() if r.doc_id}
    assert out[3].text == rows[2][1] and out[4].text == "one\ntwo" and out[4].n_chars == 7
    assert out[5].text == "" and out[6].text is None
    assert substrings.find_repeats(table(spark, [])).count() == 0
    two = substrings.find_repeats(table(spark, [(1, prose(60)), (1, prose(60))])).collect()
    assert [r.n_removed for r in two] == [0, 0]


def test_toxicity(spark):
    out = LLM_QUERIES["op7_toxicity"](spark, f"{DATA}/sf0.1")
    labels = read(spark, "sf0.1", "labels")
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(toxic) > 0.85 * len(toxic) and sum(clean) < 0.02 * len(clean)
    assert out.count() == read(spark, "sf0.1").count()


def test_toxicity_odd_rows(spark):
    docs = table(spark, [*odd_rows(), (None, "idiot")], score="s", predicted="p")
    labels = spark.createDataFrame([(6, 1), (7, 0), (None, 1), (8, None), (99, 1)], "doc_id bigint, toxic int")
    for given in (labels, labels.limit(0)):
        out = toxicity.score_toxicity(docs, toxicity.train(docs, given)).collect()
        assert len(out) == len(odd_rows()) + 1
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert toxicity.score_toxicity(docs.limit(0), toxicity.train(docs, labels)).count() == 0


def test_machine_learns_interactions():
    """Either term alone is harmless, both together are not: beyond any additive weights."""
    rng = np.random.default_rng(0)
    docs, rows, labels = [], [], []
    for i in range(3000):
        a, b = rng.random(2) < 0.5
        found = [0] * int(a) + [1] * int(b) + [2 + int(rng.integers(5))]
        docs += [i] * len(found)
        rows += found
        labels.append(float(a == b))
    docs, rows = np.array(docs), np.array(rows)
    bias, weights, factors = toxicity.fit(docs, rows, np.array(labels), 7)
    machine = toxicity.Machine(bias, np.arange(7), weights, factors)
    right = (machine.scores(docs, rows, 3000) >= 0.5) == np.array(labels)
    assert right.mean() > 0.99
