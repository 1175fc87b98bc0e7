"""Analysis inputs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions.text import strip, word_tokens
from corpuslens.operators.selection import clusterable
from corpuslens.storage import spread, work_path

KEYWORDS = ("thatin", "ononst", "inoran", "orantion", "privacy")
TREND_TYPES = ("AUTOMOBILE", "BUILDING", "MACHINERY")
VECTOR_WIDTH = 8
# Neighbouring ids that form one block to cluster.
BLOCK_IDS = 100
# What the BibTeX export adds around an abstract.
DEEP_HEAD = "{" * 12 + "deep" + "}" * 12 + " "
AT_LINE = "\n@handle of an author"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with their ids."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def document_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: the text is the abstract, source and id make the title."""
    docs = table(spark, sf_dir, "documents")
    title = F.concat_ws(" ", "source", "lang", F.col("doc_id").cast("string"))
    return spread(
        docs.select(
            F.col("doc_id").alias("ord"),
            title.alias("title"),
            F.col("text").alias("abstract"),
            "source",
            "lang",
        )
    )


def document_pairs(spark: SparkSession, sf_dir: str, heads: bool = False) -> DataFrame:
    """Every document with its successor by id: ``a_id, b_id, text_a, text_b``.

    With ``heads``, of a text its first character that is no whitespace, for those who only ask if there is one.
    """
    docs = documents(spark, sf_dir)
    if heads:
        docs = docs.select("doc_id", F.left(strip(F.col("text")), F.lit(1)).alias("text"))
    first = docs.select(F.col("doc_id").alias("a_id"), F.col("text").alias("text_a"))
    second = docs.select(
        (F.col("doc_id") - 1).alias("a_id"),
        F.col("doc_id").alias("b_id"),
        F.col("text").alias("text_b"),
    )
    return first.join(second, "a_id").select("a_id", "b_id", "text_a", "text_b")


def name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part name with its successor's."""
    part = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name"))
    first = part.select(F.col("p_partkey").alias("a_id"), F.col("p_name").alias("text_a"))
    second = part.select(
        (F.col("p_partkey") - 1).alias("a_id"),
        F.col("p_partkey").alias("b_id"),
        F.col("p_name").alias("text_b"),
    )
    return first.join(second, "a_id").select("a_id", "b_id", "text_a", "text_b")


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as short texts: ``doc_id, text``."""
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("text"))


def part_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An embedding for every part, the vectors taken by turns: ``doc_id, vector``."""
    vectors = table(spark, sf_dir, "embeddings")
    turn = F.pmod(F.col("doc_id"), vectors.agg(F.count(F.lit(1))).scalar())
    return part_names(spark, sf_dir).select("doc_id", turn.alias("vec_id")).join(vectors, "vec_id").select(
        "doc_id", F.col("embedding").alias("vector")
    )


def document_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An embedding for every document, the vectors taken by turns: ``doc_id, vector``."""
    vectors = table(spark, sf_dir, "embeddings")
    turn = F.pmod(F.col("doc_id"), vectors.agg(F.count(F.lit(1))).scalar())
    ids = documents(spark, sf_dir).select("doc_id", turn.alias("vec_id"))
    return ids.join(vectors, "vec_id").select("doc_id", F.col("embedding").alias("vector"))


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as publications: order year, customer's nation as journal, segment as type.

    One year, one journal and one type are missing, as they are in exports.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.nullif(F.year("o_orderdate"), F.lit(1993)).alias("year"),
            F.nullif(F.col("n_name"), F.lit("CANADA")).alias("journal"),
            F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("document_type"),
        )
    )


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whitespace word of every document, one row per occurrence."""
    return documents(spark, sf_dir).select(
        "doc_id", F.explode(F.split("text", r"\s+")).alias("word")
    )


def word_vectors(texts: DataFrame) -> DataFrame:
    """A vector for every distinct token of the texts, read off the token's MD5 digest."""
    tokens = texts.select(F.explode(word_tokens(F.col("text"))).alias("token")).distinct()
    digest = F.md5("token")
    parts = [
        (F.conv(F.substring(digest, 1 + 4 * i, 4), 16, 10).cast("double") / 65535 - 0.5)
        for i in range(VECTOR_WIDTH)
    ]
    return tokens.select("token", F.array(*parts).alias("vector"))


def author_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an author list made of all their words: ``doc_id, authors``."""
    return documents(spark, sf_dir).select(
        "doc_id", F.regexp_replace("text", r"\s+", "; ").alias("authors")
    )


def cluster_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every clusterable document, in blocks of neighbouring ids: ``block, doc_id, text, title``.

    The ids of a block span a fixed range, so its size is bounded whatever the corpus.
    """
    articles = clusterable(document_articles(spark, sf_dir))
    return articles.select(
        F.expr(f"ord div {BLOCK_IDS}").alias("block"),
        F.col("ord").alias("doc_id"),
        F.col("abstract").alias("text"),
        "title",
    )


def plural_lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lemma table for the documents' own words: a final s is dropped from words over three."""
    own = F.array_distinct(F.filter(word_tokens(F.col("text")), lambda t: t.endswith("s")))
    plurals = documents(spark, sf_dir).select(F.explode(own).alias("token")).filter(F.col("token").rlike("^.{3,}s$")).distinct()
    return plurals.select("token", F.regexp_replace("token", "s$", "").alias("lemma"))


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as articles whose title is the address: ``ord, title``."""
    pages = table(spark, sf_dir, "pages")
    return pages.select(F.col("page_id").alias("ord"), F.col("url").alias("title"))


def part_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as articles whose title is the name: ``ord, title``."""
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("ord"), F.col("p_name").alias("title"))


def _export_fields(spark: SparkSession, sf_dir: str, part: int | None = None) -> DataFrame:
    """Documents with the fields of a bibliographic export, all of them text.

    With ``part``, only one of three parts of the documents, in order, titled by their own heads.
    """
    docs = table(spark, sf_dir, "documents")
    number = F.col("doc_id").cast("string")
    year = (F.lit(1990) + F.col("doc_id") % 30).cast("string")
    kind = F.col("doc_id") % 4
    title = F.concat_ws(" ", "source", "lang", number)
    if part is not None:
        docs = docs.filter(F.col("doc_id") % 3 == part).orderBy("doc_id")
        title = F.regexp_replace(F.left("text", F.lit(60)), r"\s+", " ")
    fields = (
        docs.select(
            title.alias("title"),
            F.concat(F.initcap("lang"), F.lit(", A.; "), "source").alias("authors"),
            F.concat("lang", F.lit("; "), "source").alias("keywords"),
            F.col("text").alias("abstract"),
            F.col("source").alias("journal"),
            year.alias("year"),
            F.when(kind == 1, F.concat(year, F.lit("-05-01")))
            .when(kind == 2, F.concat(year, F.lit(".0")))
            .otherwise(year)
            .alias("date"),
            F.concat(F.lit("10.1/"), number).alias("doi"),
            F.concat(F.lit("http://x/"), number).alias("url"),
            F.when(kind == 1, "Conference").when(kind == 2, "Periodical").alias("kind"),
        )
    )
    return spread(fields) if part is None else fields


def csv_export(spark: SparkSession, sf_dir: str, part: int | None = None) -> str:
    """Write the documents as a CSV export and return its path."""
    path = work_path(spark, "export.csv")
    _export_fields(spark, sf_dir, part).select(
        "title",
        F.col("authors").alias("contributors"),
        F.col("keywords").alias("subjects"),
        "abstract",
        F.col("journal").alias("source"),
        F.col("date").alias("publicationDate"),
        "doi",
        F.col("url").alias("plink"),
        F.col("kind").alias("docTypes"),
    ).write.options(header=True, quote='"', escape='"').csv(path)
    return path


def bibtex_export(spark: SparkSession, sf_dir: str, part: int | None = None) -> str:
    """Write the documents as BibTeX entries and return the path.

    Abstracts hold deeply nested braces and a line that starts with ``@``; keywords are joined
    from parts.
    """
    path = work_path(spark, "export.bib")
    listed = F.split("keywords", "; ")
    braced = {
        "title": F.col("title"),
        "author": F.replace("authors", F.lit("; "), F.lit(" and ")),
        "abstract": F.concat(F.lit(DEEP_HEAD), "abstract", F.lit(AT_LINE)),
        "journal": F.col("journal"),
        "year": F.col("year"),
        "doi": F.col("doi"),
        "url": F.col("url"),
    }
    lines = [F.concat(F.lit(f"  {n} = {{"), v, F.lit("}")) for n, v in braced.items()]
    joined = F.concat(F.lit('  keywords = "'), listed[0], F.lit('" # ", " # {'), listed[1], F.lit("}"))
    entry = F.concat(F.lit("@article{key,\n"), F.concat_ws(",\n", joined, *lines), F.lit("\n}\n"))
    _export_fields(spark, sf_dir, part).select(entry.alias("value")).write.text(path)
    return path


def ris_export(spark: SparkSession, sf_dir: str, part: int | None = None) -> str:
    """Write the documents as RIS references, abstracts wrapped, and return the path."""
    path = work_path(spark, "export.ris")

    def line(tag: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{tag}  - "), value)

    def repeated(tag: str, column: str) -> Column:
        return F.array_join(F.transform(F.split(column, "; "), lambda v: line(tag, v)), "\n")

    reference = F.concat_ws(
        "\n",
        line("TY", F.lit("JOUR")),
        line("TI", "title"),
        repeated("AU", "authors"),
        repeated("KW", "keywords"),
        line("PY", "year"),
        line("DO", "doi"),
        line("DB", "journal"),
        line("UR", "url"),
        line("AB", "abstract"),
        F.lit("ER  - "),
    )
    _export_fields(spark, sf_dir, part).select(reference.alias("value")).write.text(path)
    return path


def mixed_exports(spark: SparkSession, sf_dir: str) -> list[tuple[str, str]]:
    """Three exports that hold all documents between them: CSV, BibTeX and RIS, with their labels."""
    return [
        ("EBSCO", csv_export(spark, sf_dir, 0)),
        ("ACM", bibtex_export(spark, sf_dir, 1)),
        ("SCOPUS", ris_export(spark, sf_dir, 2)),
    ]
