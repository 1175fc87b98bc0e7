import pytest
from corpuslens.operators import geography, trends
from corpuslens.schema import MissingColumnsError

AUTHORS = {
    "Smith, John; Doe, Jane": ("Smith", "United States"),
    "John Smith; X": ("John", "United States"),
    "PATRUT, A": ("PATRUT", "Romania"),
    "gonzález-bravo, L": ("gonzález-bravo", "Mexico"),
    "Hansen, K": ("Hansen", "India"),
    "Lindberg, K": ("Lindberg", "Germany"),
    "Fernandez, P": ("Fernandez", "Mexico"),
    "Ivanov, I": ("Ivanov", "Russia"),
    "ŞAHİN": ("ŞAHİN", None),
    "王, 小": ("王", "China"),
    "محمد": ("محمد", "Egypt"),
    "Karaoglan Yilmaz, F": ("Karaoglan Yilmaz", "Turkey"),
    "S": ("S", "India"),
    "": ("", "Unknown"),
    " ; Doe": ("", "Unknown"),
    ", John": ("", "Unknown"),
    "Nguyen, V": ("Nguyen", "Vietnam"),
    "Kim Lee": ("Kim", "South Korea"),
    "Santos Silva, M": ("Santos Silva", "Mexico"),
}


def test_country_from_authors(spark):
    df = spark.createDataFrame([(a,) for a in AUTHORS] + [(None,)], "authors string")
    for r in geography.country_from_authors(df).collect():
        surname, country = AUTHORS.get(r.authors, ("", "Unknown"))
        assert r.surname == surname
        if country:
            assert (r.authors, r.country) == (r.authors, country)


def test_country_counts_and_kpis(spark):
    df = spark.createDataFrame([("Kumar, A",)] * 3 + [("Doe, J",)] * 2 + [("",), (None,)], "authors string")
    counts = geography.country_counts(df)
    assert [tuple(r) for r in counts.collect()] == [("India", 3), ("United States", 2)]
    assert tuple(geography.country_kpis(counts).first()) == (5, 2, "India")
    with pytest.raises(MissingColumnsError):
        geography.country_counts(df.withColumnRenamed("authors", "x"))


@pytest.fixture(scope="module")
def articles(spark):
    long_a, long_b = "J" * 60 + "a", "J" * 60 + "b"
    rows = (
        [(2020, long_a, "Conference")] * 4 + [(2021, long_b, "conference ")] * 4
        + [(2020, f"c{i}", "Conference") for i in range(6)]
        + [(2019, None, None), (None, "x", "Article"), (2019, " pad ", "Article"), (2018, "pad", "Periodical")]
    )
    return trends.trend_clean(spark.createDataFrame(rows, "year int, journal string, document_type string"))


def test_clean_and_kpis(articles):
    assert articles.filter("journal = 'Desconocida' and document_type = 'Article'").count() == 1
    assert tuple(trends.trend_kpis(articles).first()) == (17, 4, 10, 4)
    assert [r.year for r in trends.distinct_years(articles).collect()] == [2018, 2019, 2020, 2021]
    assert trends.year_range(articles, 2019, 2020).count() == 12


def test_timeline_merges_long_names_and_bucket(articles):
    conference = trends.of_type(articles, "CONFERENCE")
    cells = {(r.year, r.journal_display): r["count"] for r in trends.year_journal_counts(conference, 5).collect()}
    head = "J" * 55 + "…"
    assert cells == {
        (2020, head): 4, (2021, head): 4, (2020, "c0"): 1, (2020, "c1"): 1, (2020, "c2"): 1,
        (2020, trends.OTHER_JOURNALS): 3,
    }
    order = trends.display_order(trends.year_journal_counts(conference, 5)).collect()
    assert [r[0] for r in order] == [head, "c0", "c1", "c2", trends.OTHER_JOURNALS]
    per_type = trends.per_type_trend(articles, 5).filter("document_type = 'conference'").collect()
    assert {(r.year, r.journal_display): r["count"] for r in per_type} == cells
    with pytest.raises(ValueError):
        trends.top_journals(conference, 0)


def test_type_kpis_and_tables(articles):
    kpis = {r.document_type: tuple(r)[1:] for r in trends.type_kpis(articles).collect()}
    assert kpis["conference"] == (14, 2020, "J" * 45 + "…")
    assert kpis["article"] == (2, 2019, "Desconocida") and kpis["periodical"] == (1, 2018, "pad")
    table = trends.year_journal_table(articles).collect()
    assert [r.year for r in table] == sorted(r.year for r in table) and table[3]["count"] == 4
    assert trends.year_type_counts(articles).count() == 4
    assert trends.year_type_journal_table(articles).count() == 11
