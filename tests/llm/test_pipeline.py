from collections import Counter

import __spark_entry__ as contract
from brute import DATA, near_classes, odd_rows, prose, read, repeats, table
from test_arrays_and_joins import check_packing

from pyspark.sql import functions as F

import corpus_pipeline
from corpuslens.llm.mixing import mix_sources
from corpuslens.storage import stage


def test_registered():
    names = [n.split("_")[0] for n in contract.queries()]
    assert all(f"op{i}" in names for i in range(1, 11)) and "pipeline" in names


def test_stages_against_brute_force(spark):
    sf_dir = f"{DATA}/sf0.01"
    docs = read(spark, "sf0.01")
    results = []
    for name, function in corpus_pipeline.STAGES:
        given, docs = docs, stage(function(spark, docs, sf_dir), name)
        results.append((given, docs))
    for given, kept in results[:4]:
        assert kept.columns == given.columns == read(spark, "sf0.01").columns
    rows = [[(r.doc_id, r.text) for r in kept.collect()] for _, kept in results[:4]]
    given = [(r.doc_id, r.text) for r in results[0][0].collect()]
    toxic = {r.doc_id for r in read(spark, "sf0.01", "labels").filter("toxic = 1").collect()}
    gone = {d for d, _ in given} - {d for d, _ in rows[0]}
    assert len(gone & toxic) > 0.5 * len(toxic) and dict(rows[0]).items() <= dict(given).items()
    assert sorted(rows[1]) == sorted((d, t) for (d, t), (_, c, _) in zip(rows[0], near_classes(rows[0])) if d == c)
    cut = repeats(rows[1])
    before = dict(rows[1])
    for d, text in rows[2]:
        assert len(text.split()) == len(before[d].split()) - cut[d][1] or "\u00a0" in text
        assert cut[d][1] or text == before[d]
    assert sorted(rows[3]) == sorted(rows[2])
    used, least = check_packing(results[4][1].collect(), rows[3])
    assert used <= 1.01 * least
    assert corpus_pipeline.run(spark, sf_dir).count() == results[4][1].count()


def test_odd_and_empty_tables(spark):
    for rows in (odd_rows(), []):
        docs = table(spark, rows)
        for name, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, f"{DATA}/sf0.001"), name)
        assert (docs.count() > 0) == bool(rows)


def test_packing_follows_the_mix(spark):
    # Sources lie one behind the other; the hot one holds a third of the rows.
    names = ["hot"] * 6 + list("abcdefghijkl")
    rows = [(i, names[i // 200], f"{prose(5 + i * 7919 % 400, i)}") for i in range(3600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    mixed = stage(corpus_pipeline.mixing(spark, docs, ""), "mixed")
    out = corpus_pipeline.packing(spark, mixed, "").collect()
    assert check_packing(out, [(d, t) for d, _, t in rows])[0] == len({r.sequence_id for r in out})
    slot = {r.doc_id: r.slot for r in mix_sources(docs).collect()}
    order = sorted(slot, key=slot.get)
    ids = {s: i for i, s in enumerate(sorted({r.sequence_id for r in out}))}
    first = {r.doc_id: ids[r.sequence_id] for r in out if r.piece == 0}
    source = {d: s for d, s, _ in rows}
    for part in (8, 4, 2):
        early = [d for d in first if first[d] < len(ids) // part]
        wanted = Counter(source[d] for d in order[: len(early)])
        found = Counter(source[d] for d in early)
        assert all(abs(found[s] - wanted[s]) < 0.06 * len(early) for s in set(source.values()))


CLASHES = ["score", "predicted", "slot", "offset", "weight", "block", "release", "deadline", "_rows", "_kept", "_spans", "_id", "_part", "_file", "_row", "_slot", "_doc_id", "_source", "_text", "n_words"]


def test_stages_keep_columns_of_their_own_names(spark):
    docs = table(spark, [*odd_rows(), (70, "you idiot " * 5)]).withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    for name, function in corpus_pipeline.STAGES[:4]:
        docs = stage(function(spark, docs, f"{DATA}/sf0.01"), name)
        rows = docs.select(*CLASHES).distinct().collect()
        assert rows == [tuple(f"own {c}" for c in CLASHES)], name
    assert corpus_pipeline.packing(spark, docs, "").count() > 0


def test_stages_may_be_chained_without_storing(spark):
    sf_dir = f"{DATA}/sf0.001"
    docs = read(spark, "sf0.001")
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, sf_dir)
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, docs.collect())) == sorted(map(key, corpus_pipeline.run(spark, sf_dir).collect()))
