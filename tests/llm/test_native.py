import re
import unicodedata
from collections import Counter, defaultdict

import pytest
import xxhash
from brute import DATA, odd_rows, prose, read, table, words
from pathlib import Path
from pyspark.sql import functions as F
from verify import _rows, difference, duck

from corpuslens.llm import fingerprints, licenses, mixing, quality
from corpuslens.llm.oracle import LLM_SQL
from corpuslens.llm.queries import LLM_QUERIES, URL_RULES
from corpuslens.llm.urls import judge_urls


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_equals_sql(spark, name):
    df = LLM_QUERIES[name](spark, f"{DATA}/sf0.01")
    cursor = duck(Path(DATA) / "sf0.01").execute(LLM_SQL[name])
    theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    assert difference(_rows(df.columns, [tuple(r) for r in df.collect()]), theirs) is None


def test_url_rules(spark):
    cases = {
        "http://a.example.net/en/x": "example.net/en/", "http://example.net/de/": "net/", "http://xnet/": None,
        "http://A.Example.COM/de/1?q#f": "example.com/de/", "https://net/": "net/", "http://b.org/fr": None,
        "http://b.org/fr/": "org/fr/", "no scheme.net/": None, "": None, None: None, "http://a.net": None,
        "http://a.net?x=/": None, "x://y://z.net/": None, "http://é.net/ü": "net/",
    }
    rows = [(i, u) for i, u in enumerate([*cases, *cases])]
    pages = spark.createDataFrame(rows, "page_id int, url string").withColumn("rule", F.lit(1)).withColumn("host", F.lit("h"))
    out = judge_urls(pages, URL_RULES).collect()
    assert len(out) == len(rows)
    assert {r.url: r.rule for r in out} == cases
    assert {r.url: r.host for r in out}["http://A.Example.COM/de/1?q#f"] == "a.example.com"
    assert all(r.verdict == ("block" if r.rule in ("net/", "example.com/de/") else "allow") for r in out)
    assert judge_urls(pages.limit(0), URL_RULES).count() == 0
    both = judge_urls(pages, [("allow", "net/"), ("block", "net/")]).filter("rule = 'net/'")
    assert {r.verdict for r in both.collect()} == {"block"}


def best_license(text):
    found = []
    normal = re.sub(r"[^\w\n]|_", " ", (text or "").lower())
    parts = normal.split("\n")
    blocks = [b for b in re.split(r"\n *\n", re.sub(r"[^\w\n]+", " ", normal)) if "\n" in b.strip(" ")]
    for s in [*parts, *blocks, *([normal] if len(parts) > 1 else [])]:
        w = s.split()
        grams = set(zip(w, w[1:]))
        for name, t in licenses.TEMPLATES.items():
            wanted = {tuple(g.split(" ")) for g in licenses.template_bigrams(t)}
            dice = 2 * len(grams & wanted) / (len(grams) + len(wanted)) if wanted else 0
            if dice >= licenses.THRESHOLD:
                found.append((-dice, name))
    return (min(found)[1], -min(found)[0]) if found else (None, None)


def test_licenses(spark):
    rows = [
        *odd_rows(), (20, prose(50) + "\nReleased under the MIT License."), (21, "released UNDER the *MIT* license"),
        (22, "This work is licensed under the GNU General\nPublic License, version 3."), (23, "All rights reserved.\nLicensed under CC BY-NC 4.0."),
        (24, "This work is licensed under the GNU General Public License, version 2.1"), (25, "MIT License"),
    ]
    docs = table(spark, rows, license=1, dice="x").unionByName(read(spark, "sf0.001").withColumns({"license": F.lit(1), "dice": F.lit("x")}))
    out = licenses.scan_licenses(docs).collect()
    assert len(out) == len(rows) + 200
    for r in out:
        name, dice = best_license(r.text)
        assert r.license == name and (r.dice == pytest.approx(dice) if dice else r.dice is None), r
    found = {r.doc_id: r for r in out if r.doc_id in (22, 23) and r.n_chars < 100}
    assert found[22].license == "GPL-3.0" and len(found[23].licenses) >= 2
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
    assert licenses.scan_licenses(docs, templates={"x": "one"}).filter("license IS NOT NULL").count() == 0


def base_counts(text):
    w = words(text)
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i : i + 5])].append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality(spark):
    odd = [*odd_rows(), (30, "a b c d e a b c d e f"), (31, "x " * 400), (32, "l1\nl1\n \n \nl1\nl2"), (33, "# $ | <b> 100%")]
    docs = table(spark, odd, kept=7, votes="v").unionByName(read(spark, "sf0.001").withColumns({"kept": F.lit(7), "votes": F.lit("v")}))
    out = quality.judge_quality(docs).collect()
    assert len(out) == len(odd) + 200
    for r in out:
        assert tuple(r[c] for c in quality.BASE) == base_counts(r.text), r
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= quality.KEEP_FROM)
    assert quality.judge_quality(docs.limit(0)).count() == 0


def test_quality_agrees_with_labels(spark):
    out = LLM_QUERIES["op3_quality"](spark, f"{DATA}/sf0.1").select("doc_id", "kept", "n_words")
    labels = read(spark, "sf0.1", "labels").withColumnRenamed("quality", "label")
    n = Counter((r.label, r.kept) for r in out.join(labels, "doc_id").filter("n_words >= 10").collect())
    assert n[0, False] > 0.95 * (n[0, False] + n[0, True])
    assert n[1, True] > 0.98 * (n[1, False] + n[1, True])


def plain_votes(text):
    """The votes of the rules on a text, by their definition."""
    w, chars, symbols, dup_lines, repeats = base_counts(text)
    lines = sum(bool(words(x)) for x in (text or "").split("\n"))
    upper = sum(unicodedata.category(c) == "Lu" for c in text or "")
    return (
        -(10 * symbols > w), -(chars < 2 * w or chars > 12 * w), -(4 * dup_lines > lines), -(100 * repeats > 15 * w),
        -(2 * upper > chars), int(w >= 50 and 50 * symbols <= w and 3 * w <= chars <= 8 * w and not dup_lines),
    )


def plain_posteriors(counts, rounds=50):
    """{pattern: posterior}: expectation-maximisation written over expanded rates, not ratios."""
    expected = {1: (0.5, 0.1), 0: (0.49, 0.6), -1: (0.01, 0.3)}
    total, rules = sum(counts.values()), range(len(next(iter(counts))))
    rates = [[{v: expected[v][c] for v in expected} for _ in rules] for c in (0, 1)]
    share = [0.9, 0.1]

    def posterior(p):
        ratio = share[0] / share[1]
        for j, v in enumerate(p):
            r = rates[0][j][v] / rates[1][j][v]
            ratio *= max(r, 1) if v > 0 else min(r, 1) if v < 0 else r
        return ratio / (1 + ratio)

    for _ in range(rounds):
        found = {p: posterior(p) for p in counts}
        mass = [sum(n * q for (p, n), q in zip(counts.items(), found.values()))]
        mass.append(total - mass[0])
        held = [0.2 * mass[0], 0.2 * (mass[1] + 0.1 * total)]
        for c in (0, 1):
            for j in rules:
                for v in expected:
                    cast = sum(n * (found[p] if c == 0 else 1 - found[p]) for p, n in counts.items() if p[j] == v)
                    rates[c][j][v] = (cast + held[c] * expected[v][c]) / (mass[c] + held[c])
            share[c] = (mass[c] + total * (0.9, 0.1)[c]) / (2 * total)
    return {p: posterior(p) for p in counts}


def test_whole_verdict(spark):
    """Votes, estimation and verdict of every document against the definition."""
    out = LLM_QUERIES["op3_quality"](spark, f"{DATA}/sf0.01").collect()
    texts = {r.doc_id: r.text for r in read(spark, "sf0.01").collect()}
    assert len(out) == len(texts)
    votes = {d: plain_votes(t) for d, t in texts.items()}
    failed = {d: n < 10 or 100 * r > 20 * n for d, (n, _, _, _, r) in ((d, base_counts(t)) for d, t in texts.items())}
    posterior = plain_posteriors(Counter(votes[d] for d in texts if not failed[d]))
    rejected = 0
    for r in out:
        assert tuple(r.votes) == votes[r.doc_id] and r.base_failed == failed[r.doc_id]
        if failed[r.doc_id]:
            assert not r.kept
        else:
            assert r.quality == pytest.approx(posterior[votes[r.doc_id]], abs=1e-9)
            assert r.kept == (posterior[votes[r.doc_id]] >= 0.5)
            rejected += not r.kept
    assert 20 < rejected < 200


def test_estimate_weighs_votes():
    model = quality.estimate([((1, 0), 700), ((1, -1), 5), ((-1, -1), 60), ((-1, 0), 35), ((0, 0), 200)])
    assert model.good[0] > 0 > model.bad[0] and model.bad[1] < 0
    assert model.log_odds((1, 0)) > 0 > model.log_odds((-1, -1))
    assert quality.estimate([]).log_odds(()) > 0


def spark_hash(*values):
    h = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & (2**64 - 1)).to_bytes(8, "little")
        h = xxhash.xxh64_intdigest(data, seed=h)
    return h - 2**64 if h >= 2**63 else h


def closed_syncmers(text):
    w = words(text)
    if len(w) < 5:
        return [(0, spark_hash(" ".join(w)))] if w else []
    single = [spark_hash(x) for x in w]
    pair = [spark_hash(a, b) for a, b in zip(single, single[1:])]
    out = []
    for i in range(len(w) - 4):
        inner = pair[i : i + 4]
        if min(inner) in (inner[0], inner[3]):
            out.append((i, spark_hash(inner[0], inner[2], inner[3])))
    return out


def test_syncmers_and_sketch(spark):
    docs = table(spark, odd_rows(), hash=1, position=2)
    rows = docs.select("text", fingerprints.syncmers(F.col("text")).alias("s"), fingerprints.sketch(F.col("text")).alias("k")).collect()
    for r in rows:
        expected = closed_syncmers(r.text)
        assert [tuple(x) for x in r.s] == expected
        assert r.k == sorted({h >> 32 for _, h in expected})[: fingerprints.SKETCH]
    assert fingerprints.anchors(docs).count() == sum(len(r.s) for r in rows)


@pytest.mark.parametrize("run_rows", [1024, 3])
def test_fingerprint_neighbours(spark, monkeypatch, run_rows):
    import hashlib

    monkeypatch.setattr(fingerprints, "RUN_ROWS", run_rows)
    rows = [(d, t) for d, t in odd_rows()] + [(None, "no id " * 9), (100, prose(300)), (101, prose(300))]
    out = fingerprints.fingerprint_neighbours(table(spark, rows, run=1, copy=2)).collect()
    order = sorted(((d is not None, d or 0), t or "") for d, t in rows)
    expected = Counter()
    for i, ((_, d), t) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        expected[d, len(t), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id or 0, r.n_chars, r.edited_sha256) for r in out) == expected
    by = {r.doc_id: r for r in out}
    assert by[6].fingerprint == by[7].fingerprint and by[6].near_next == 1.0
    assert by[1].near_edited == by[1].near_next == 1.0 and 0.2 < by[9].near_edited < 0.7
    assert by[101].near_edited > by[101].near_next
    one = fingerprints.fingerprint_neighbours(table(spark, [(5, "a b c d")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()
    assert fingerprints.fingerprint_neighbours(table(spark, [])).count() == 0


def test_pfair_schedule():
    for weights in ({"a": 5, "b": 3, "c": 1}, {"x": 0.34, "y": 0.33, "z": 0.33, "w": 1e-9}, {"only": 2}):
        slots = mixing.rounded(weights, 97)
        plan = mixing.schedule(slots)
        period, taken = len(plan), Counter()
        assert Counter(s for s, *_ in plan) == slots
        for t, (s, release, due, i) in enumerate(plan):
            assert release <= t < due and taken[s] == i
            taken[s] += 1
            for name, n in slots.items():
                assert abs(taken[name] * period - n * (t + 1)) < period


def test_mix_sources(spark):
    rows = [*odd_rows(), *[(1000 + i, f"t{i}") for i in range(500)], (None, "x"), (None, "x")]
    docs = table(spark, rows, slot="s", weight=0)
    docs = docs.withColumn("source", F.when(F.col("doc_id") > 1100, "hot").otherwise(F.col("source")))
    out = mixing.mix_sources(docs, block=4, grain=64).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter(rows)
    placed = Counter((r.slot, r.offset) for r in out)
    assert max(placed.values()) == 1 and len({r.slot for r in out}) == max(r.slot for r in out) + 1
    of_slot = {r.slot: r.source for r in out}
    assert all(of_slot[r.slot] == r.source and r.release <= r.slot < r.deadline for r in out)
    # Until the first source runs out, each has its share of slots within one block.
    weight = {r.source: r.weight for r in out if r.block == 0}
    total = Counter(of_slot.values())
    taken = Counter()
    for slot in sorted(of_slot):
        taken[of_slot[slot]] += 1
        assert all(abs(taken[s] - w * (slot + 1)) < 1 for s, w in weight.items())
        if any(taken[s] == n for s, n in total.items()):
            break
    fixed = mixing.mix_sources(docs, weights={"hot": 3.0, "a": 1.0}, carry=["doc_id", "source"], block=4)
    assert fixed.count() == len(rows) and "text" not in fixed.columns
    assert mixing.mix_sources(docs.limit(0)).count() == 0


@pytest.mark.parametrize("sizes, weights", [
    ({"hot": 950, **{f"s{i}": 100 for i in range(19)}}, None),
    ({"a": 3600, "b": 400}, {"a": 0.9, "b": 0.1}),
    ({"a": 3000, "b": 2000, "c": 2}, {"a": 0.6, "b": 0.3999, "c": 0.0001}),
    ({f"s{i}": 1 + i % 3 for i in range(1100)}, {f"s{i}": 1.0 + i % 7 for i in range(1100)}),
])
def test_mix_follows_unrounded_weights(spark, sizes, weights):
    rows = [s for s, n in sizes.items() for _ in range(n)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, source string")
    out = mixing.mix_sources(docs, weights=weights, block=1).orderBy("slot").collect()
    assert [r.slot for r in out] == list(range(len(rows))) and Counter(r.source for r in out) == sizes
    target = weights or {s: n**0.5 for s, n in sizes.items()}
    left, taken, start = dict(sizes), Counter(), 0
    total = sum(target.values())
    for r in out:
        taken[r.source] += 1
        assert r.release <= r.slot < r.deadline and r.weight == pytest.approx(target[r.source] / total)
        n = r.slot - start + 1
        assert all(abs(taken[s] - n * target[s] / total) < 1 + 1e-9 for s in left)
        left[r.source] -= 1
        if not left[r.source]:  # the others go on from here
            del left[r.source]
            taken, start, total = Counter(), r.slot + 1, sum(target[s] for s in left)


def all_notices(text):
    """{template: best Dice of any run of words} by trying every run."""
    w = re.sub(r"[^\w]|_", " ", (text or "").lower()).split()
    pairs, found = list(zip(w, w[1:])), {}
    for name, t in licenses.WORDINGS.items():
        wanted = {tuple(g.split(" ")) for g in licenses.template_bigrams(t)}
        most = int(len(wanted) * 1.5 + 1e-9)
        for i in range(len(pairs)):
            run = set()
            for p in pairs[i : i + most]:
                run.add(p)
                dice = 2 * len(run & wanted) / (len(run) + len(wanted))
                if dice >= licenses.THRESHOLD:
                    found[name] = max(found.get(name, 0), dice)
    return found


def test_notices_anywhere(spark):
    mit, bsd = licenses.WORDINGS["MIT/text"], licenses.WORDINGS["BSD-3-Clause/conditions"]
    cases = {
        30: (mit, "MIT/text"), 31: ("MIT License", "MIT/title"), 33: ("Copyright 2024 Acme. All rights reserved.", "LicenseRef-reserved"),
        32: ("This project is licensed under the MIT License.", "MIT/project"), 34: (bsd, "BSD-3-Clause/conditions"),
        35: (mit.replace(" ", "\n", 40).replace("furnished", "given"), "MIT/text"), 36: ("Released under the MIT License.", "MIT"),
    }
    rows = [(d, t) for d, (t, _) in cases.items()]
    rows += [(d + 100, f"{prose(30, d)} {t} {prose(20, d + 1)}") for d, (t, _) in cases.items()]
    rows += [r for r in odd_rows() if r[0] != 9] + [(200, "the MIT of the License of the MIT License and all rights " * 5)]
    out = licenses.find_notices(table(spark, rows, dice="x")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert {h.name: pytest.approx(h.dice) for h in r.licenses} == all_notices(r.text), r
        assert [(-h.dice, h.name) for h in r.licenses] == sorted((-h.dice, h.name) for h in r.licenses)
        assert r.doc_id not in range(30, 200) or cases[r.doc_id % 100][1] in {h.name for h in r.licenses}, r
    assert {r.doc_id: r.license_text for r in out}[132] == "this project is licensed under the mit license"
    assert licenses.find_notices(table(spark, rows), templates={"x": "one"}).filter("license IS NOT NULL").count() == 0
    assert LLM_QUERIES["op5_license_wordings"](spark, f"{DATA}/sf0.001").count() == read(spark, "sf0.001").count()
