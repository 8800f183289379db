"""Problem 3 over person_merge, person and company."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import table
from .truth import discover_sources, discover_truth

#: Words that stand for "not known"; fixed values.
STAND_INS = (
    "unknown", "n/a", "na", "n.a.", "none", "null", "nil", "nan", "undefined", "anonymous", "anon", "hidden", "not given", "not known", "not available", "not specified",
    "unspecified", "no name", "no email", "deleted", "[deleted]", "removed", "[removed]", "tbd", "tba", "to be determined", "to be announced", "(none)", "(unknown)", "<unknown>", "(null)",
)


def clean(column: str) -> Column:
    """Trimmed, with single inner spaces, in lower case."""
    return F.lower(F.trim(F.regexp_replace(column, r"[\s ]+", " ")))


def real(value: Column) -> Column:
    """Is a cleaned value more than a blank or a stand-in? It needs a letter or digit."""
    return value.rlike(r"[\p{L}\p{N}]") & ~value.isin(list(STAND_INS))


def merge_claims(spark: SparkSession, folder: str) -> DataFrame:
    """What each row of a group claims for the four fields."""
    person = table(spark, folder, "person").select("id", "names_seen", "emails_seen", "location_city", "employer_company_id", "employer_seen_at", "last_observed_at")
    groups = table(spark, folder, "person_merge").select("group_id", F.col("person_id").alias("id")).dropna().distinct()
    rows = groups.join(person, "id")
    field = lambda name, value, seen: F.struct(F.lit(name).alias("field_name"), value.alias("field_value"), seen.alias("seen_at"))
    none = F.lit(None).cast("timestamp")
    each = F.array_compact(
        F.concat(
            F.transform(F.coalesce("names_seen", F.array()), lambda n: field("names_seen", n, none)),
            F.transform(F.coalesce("emails_seen", F.array()), lambda n: field("emails_seen", n, none)),
            F.array(field("location_city", F.col("location_city"), F.col("last_observed_at")), field("employer_company_id", F.col("employer_company_id"), F.col("employer_seen_at"))),
        )
    )
    claims = rows.select("group_id", F.col("id").alias("source_id"), F.explode(each).alias("c")).select("group_id", "source_id", "c.*")
    claims = claims.withColumn("field_value", clean("field_value")).filter(real(F.col("field_value")))
    claims = claims.filter((F.col("field_name") != "emails_seen") | F.col("field_value").rlike("^[^@]+@[^@]+$"))
    known = table(spark, folder, "company").select(clean("id").alias("field_value")).distinct()
    employers = claims.filter("field_name = 'employer_company_id'").join(known, "field_value", "left_semi")
    return claims.filter("field_name <> 'employer_company_id'").unionByName(employers)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """The surviving values of each group in person_merge."""
    truth = discover_truth(merge_claims(spark, folder), ("names_seen", "emails_seen"))
    return truth.select("group_id", "field_name", "field_value")


#: Fields of which no date says which value is the newest.
UNDATED = ("canonical_name", "location_country", "location_timezone", "job_role")


def source_claims(spark: SparkSession, folder: str) -> DataFrame:
    """What each row of a group claims for the undated fields; its source is the platform and
    method of its most trusted account, so that a source speaks in many groups."""
    person = table(spark, folder, "person").select("id", *UNDATED)
    account = F.struct(F.coalesce("resolution_confidence", F.lit(0)).alias("c"), F.concat_ws("/", "platform", "resolution_method").alias("s"))
    sources = table(spark, folder, "person_platform_identity").filter("person_id is not null").groupBy(F.col("person_id").alias("id")).agg(F.max(account)["s"].alias("source_id"))
    rows = table(spark, folder, "person_merge").select("group_id", F.col("person_id").alias("id")).dropna().distinct().join(person, "id").join(sources, "id", "left")
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("field_value")) for f in UNDATED])
    claims = rows.select("group_id", F.coalesce("source_id", F.lit("no account")).alias("source_id"), F.explode(each).alias("c")).select("group_id", "source_id", "c.*")
    return claims.withColumn("field_value", clean("field_value")).filter(real(F.col("field_value")))


def p3_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The surviving values of the undated fields, by sources of estimated accuracy."""
    merged, _ = discover_sources(source_claims(spark, folder))
    return merged.select("group_id", "field_name", "field_value", F.round("confidence", 4).alias("confidence"))


def p3_sources(spark: SparkSession, folder: str) -> DataFrame:
    """How accurate each source is found to be."""
    _, sources = discover_sources(source_claims(spark, folder))
    return sources.select("source_id", F.round("accuracy", 4).alias("accuracy"), "n_claims")


_WORDS = ", ".join(f"'{w}'" for w in STAND_INS)
_CLEAN = r"lower(trim(regexp_replace({}, '[\s\x{{00a0}}]+', ' ', 'g')))"
QUERIES = {"p3_found": p3_found, "p3_merged": p3_merged, "p3_sources": p3_sources}
SQL = {
    "p3_found": f"""
WITH rows_ AS (SELECT DISTINCT m.group_id, p.* FROM (SELECT DISTINCT group_id, person_id FROM person_merge) m JOIN person p ON p.id = m.person_id),
claims AS (
  SELECT group_id, 'names_seen' AS f, unnest(names_seen) AS v, NULL::TIMESTAMPTZ AS seen, id FROM rows_
  UNION ALL SELECT group_id, 'emails_seen', unnest(emails_seen), NULL, id FROM rows_
  UNION ALL SELECT group_id, 'location_city', location_city, last_observed_at, id FROM rows_
  UNION ALL SELECT group_id, 'employer_company_id', employer_company_id, employer_seen_at, id FROM rows_),
cleaned AS (SELECT group_id, f, {_CLEAN.format("v")} AS v, seen FROM claims WHERE v IS NOT NULL),
kept AS (SELECT * FROM cleaned WHERE regexp_matches(v, '[\\p{{L}}\\p{{N}}]') AND v NOT IN ({_WORDS})
  AND (f <> 'emails_seen' OR regexp_matches(v, '^[^@]+@[^@]+$')) AND (f <> 'employer_company_id' OR v IN (SELECT {_CLEAN.format("id")} FROM company)))
SELECT DISTINCT group_id, f AS field_name, v AS field_value FROM kept WHERE f IN ('names_seen', 'emails_seen')
UNION ALL SELECT group_id, f, arg_min(v, (-coalesce(epoch_us(seen), -9e18), v)) FROM kept WHERE f NOT IN ('names_seen', 'emails_seen') GROUP BY group_id, f
"""
}
