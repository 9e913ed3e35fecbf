"""Golden enrichment rows: every signal, score and label of hand-checked texts."""

import pytest
from pyspark.sql import functions as F

from jobloom.functions import scoring as S
from jobloom.operators.enrich import enrich, score_parts

NL = "\n"
# text, leadership, explicit years, inferred years, skills, score, category, seniority
GOLDEN = [
    ("Senior Backend Engineer", 28, 0, 5, 1, 45, "Engineering", "Senior"),
    ("Intern", 8, 0, 1, 0, 11, "Other", "Junior"),
    ("Product Manager", 14, 0, 2, 0, 20, "Product", "Mid"),
    ("UX Designer", 14, 0, 2, 1, 22, "Design", "Mid"),
    ("HR Generalist", 14, 0, 2, 0, 20, "Operations", "Mid"),
    ("Chief Happiness Officer", 40, 0, 10, 0, 70, "Other", "Lead"),
    ("Data Engineer", 14, 0, 2, 1, 22, "Engineering", "Mid"),
    ("VP Engineering", 40, 0, 10, 0, 70, "Engineering", "Lead"),
    ("Software Engineer" + NL + "Requires Python, AWS, and 5+ years experience.", 14, 5, 0, 2, 33,
     "Engineering", "Mid"),
    ("", 10, 0, 0, 0, 10, "Other", "Mid"),
    ("None", 14, 0, 2, 0, 20, "Other", "Mid"),
    (NL, 14, 0, 2, 0, 20, "Other", "Mid"),
    ("International Sales Manager", 14, 0, 2, 0, 20, "Operations", "Junior"),
    ("Linux Administrator", 14, 0, 2, 1, 22, "Design", "Mid"),
    ("Promotions Manager", 14, 0, 2, 0, 20, "Design", "Mid"),
    ("Jr. Developer", 14, 0, 2, 0, 20, "Engineering", "Junior"),
    ("C++ Developer", 14, 0, 2, 0, 20, "Engineering", "Mid"),
    ("Director, Finance", 14, 0, 2, 0, 20, "Operations", "Mid"),
    ("Director of Product", 40, 0, 10, 0, 70, "Product", "Lead"),
    ("Principal ML Engineer", 36, 0, 8, 1, 62, "Engineering", "Lead"),
    ("Team Leader", 14, 0, 2, 0, 20, "Other", "Mid"),
    ("Head of Talent", 14, 0, 10, 0, 44, "Operations", "Lead"),
    ("DevOps / SRE Lead", 36, 0, 7, 2, 61, "Engineering", "Lead"),
    ("Full-Stack and Full Stack Developer", 14, 0, 2, 2, 24, "Engineering", "Mid"),
    ("3-5 years accountant", 14, 5, 0, 0, 29, "Operations", "Mid"),
    ("2024 years", 14, 24, 0, 0, 44, "Other", "Mid"),
    ("100 years", 14, 0, 2, 0, 20, "Other", "Mid"),
    ("QA", 14, 0, 2, 1, 22, "Other", "Mid"),
    ("QA Engineer II", 16, 0, 3, 1, 27, "Engineering", "Mid"),
    ("Staff Engineer", 36, 0, 8, 0, 60, "Engineering", "Lead"),
    ("0 years of experience, architect", 28, 0, 8, 0, 52, "Other", "Lead"),
    ("Sr. Recruiter", 28, 0, 5, 0, 43, "Operations", "Senior"),
    ("5 yrs analyst", 14, 0, 2, 0, 20, "Other", "Mid"),
    ("minimum 7yrs, Go, Kafka", 14, 7, 0, 2, 39, "Other", "Mid"),
]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, g[0]) for i, g in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "Index long, combined_text string").withColumn(
        "Position title", F.col("combined_text"))
    parts = score_parts(df)
    out = enrich(parts, keep=["leadership", "explicit_years", "inferred_years", "skills"])
    return {r["Index"]: r for r in out.collect()}


@pytest.mark.parametrize("i", range(len(GOLDEN)))
def test_golden_row(scored, i):
    text, lead, yrs, inf, sk, score, cat, sen = GOLDEN[i]
    r = scored[i]
    assert (r["leadership"], r["explicit_years"], r["inferred_years"], r["skills"]) == (lead, yrs, inf, sk), text
    assert (r["complexity_score"], r["category"], r["seniority_level"]) == (score, cat, sen), text


def test_null_title_scores_as_text_none(spark):
    df = spark.createDataFrame([(1, None)], "Index long, `Position title` string")
    r = enrich(df).collect()[0]
    assert r["Position title"] is None
    assert (r["complexity_score"], r["category"], r["seniority_level"]) == (20, "Other", "Mid")


def test_output_columns_and_types(spark):
    df = spark.createDataFrame([(1, "Senior Backend Engineer", "x")],
                               "Index long, `Position title` string, extra string")
    out = enrich(df)
    assert out.columns == ["Index", "Position title", "complexity_score", "category", "seniority_level"]
    assert dict(out.dtypes)["complexity_score"] == "int"


def test_enrich_requires_keys(spark):
    df = spark.createDataFrame([("x",)], "`Position title` string")
    with pytest.raises(ValueError, match="Index"):
        enrich(df)


def test_sql_functions_match_columns(spark):
    S.register_sql_functions(spark)
    spark.createDataFrame([(g[0],) for g in GOLDEN], "t string").createOrReplaceTempView("golden_t")
    got = spark.sql("SELECT t, leadership_kw_score(t) l, max_years(t) y, inferred_years_if_missing(t) i, "
                    "count_skills(t) s, job_category(t) c, job_seniority(t) n FROM golden_t").collect()
    by_text = {r["t"]: r for r in got}
    for text, lead, yrs, inf, sk, _score, cat, sen in GOLDEN:
        r = by_text[text]
        assert (r["l"], r["y"], r["i"], r["s"], r["c"], r["n"]) == (lead, yrs, inf, sk, cat, sen), text


def test_one_scan_decides_like_the_patterns_alone(spark):
    """Random mixtures of term pieces, joined with and without boundaries, ASCII and not."""
    import random

    from pyspark.sql import functions as F

    from jobloom.functions import scoring as S
    from jobloom.functions import vocab as V

    rng = random.Random(8)
    terms = [t for _, ts in (*V.LEADERSHIP_TIERS, *V.INFERRED_YEARS_TIERS, *V.CATEGORY_RULES, *V.SENIORITY_RULES) for t in ts] + V.SKILLS
    plain = [t.replace("\\b", "").replace("\\", "").replace("?", rng.choice(["", "?"])).replace("[- ]", "-") for t in terms]
    pieces = plain + ["5 years of", "12+ yrs", "3-4 years", "é", "ü", "ruſt", "Kafka", "x", "_", "7", "THE", "and", "́"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", " ", "", ".", "-", "é", "\n"]) for _ in range(rng.choice([1, 2, 4, 8]))) for _ in range(4000)]
    texts = [t.title() if i % 7 == 0 else t for i, t in enumerate(texts)] + ["", None, *plain]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    df = df.withColumn("lc", F.lower("t")).withColumn("hits", S.rule_hits(F.col("lc")))
    t, lc, hits = F.col("t"), F.col("lc"), F.col("hits")
    pairs = [(S.leadership_score(t, lc), S.leadership_score(t, lc, hits)), (S.max_years(t), S.max_years(t, hits)),
             (S.count_skills(t, lc), S.count_skills(t, lc, hits)), (S.category(t, lc), S.category(t, lc, hits)),
             (S.seniority_level(t, lc), S.seniority_level(t, lc, hits)),
             (S.inferred_years(t, F.lit(0), lc), S.inferred_years(t, F.lit(0), lc, hits))]
    rows = df.select("t", *[c.alias(f"c{k}_{side}") for k, pair in enumerate(pairs) for side, c in zip("ab", pair, strict=True)]).collect()
    wrong = [(k, r["t"], r[f"c{k}_a"], r[f"c{k}_b"]) for r in rows for k in range(len(pairs)) if r[f"c{k}_a"] != r[f"c{k}_b"]]
    assert not wrong, wrong[:5]
    for k in range(len(pairs)):
        assert len({r[f"c{k}_a"] for r in rows}) > 2
