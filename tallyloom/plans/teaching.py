"""Teaching reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import scale
from tallyloom.functions.dates import academic_year, calendar_year, term_number
from tallyloom.operators.groups import PART_ROWS, bucket, concat_group, long_summary
from tallyloom.operators.joins import Lookup, lookup
from tallyloom.operators.quality import Gate, unique_violations
from tallyloom.operators.sets import union_layouts
from tallyloom.operators.windows import latest_per, rank_in
from tallyloom.sources.tables import register_view


def teaching_detail(by_year: DataFrame, by_code: DataFrame) -> DataFrame:
    """Sections of two systems in one layout, one row per (section, person).

    by_year: section_id, person_id, course_code, year, term, hours, students, score;
    by_code: class_id, person_id, course_code, term_code, hours, students.  Of rows without a section
    or person only exact copies are dropped.  `n_teachers` counts the persons of a section.  The
    deduplicated rows are used twice, so they are written once.
    """
    first = by_year.withColumn("audience", F.lit("undergraduate"))
    second = by_code.select(
        F.col("class_id").alias("section_id"), "person_id", "course_code", academic_year("term_code").alias("year"),
        term_number("term_code").alias("term"), "hours", "students", F.lit("graduate").alias("audience"))
    stacked = union_layouts([first.withColumn("term", F.col("term").cast("string")), second], distinct=False)
    keyed = F.col("section_id").isNotNull() & F.col("person_id").isNotNull()
    best = latest_per(stacked.filter(keyed), ["section_id", "audience", "person_id"],
                      [F.desc("hours"), F.desc("students"), F.asc("year"), F.asc("term"), F.asc("course_code"),
                       F.asc_nulls_last("score")])
    rows = scale.written(best.unionByName(stacked.filter(~keyed).distinct()))
    teachers = rows.groupBy("section_id", "audience").agg(F.count("person_id").alias("n_teachers"))
    return rows.join(scale.join_side(teachers), ["section_id", "audience"], "left")


def teaching_rows(detail: DataFrame, people: DataFrame, titles: DataFrame) -> DataFrame:
    """Workload rows: person attributes, and hours shared among a section's teachers.

    people: person_id (unique), dept, college, gender, age; titles: person_id, seq, title.
    """
    newest = titles.groupBy("person_id").agg(F.max_by("title", F.struct("seq", "title")).alias("title"))
    named = lookup(detail, [
        Lookup(people, [("person_id", "person_id")], {c: c for c in ("dept", "college", "gender", "age")},
               unique=True),
        Lookup(scale.join_side(newest), [("person_id", "person_id")], {"title": "title"}, unique=True)])
    return named.withColumn("hours_share", F.round(F.try_divide("hours", F.coalesce("n_teachers", F.lit(1))), 0))


def teaching_load(detail: DataFrame, people: DataFrame, titles: DataFrame) -> DataFrame:
    """`teaching_rows` with a rank inside a college and term, by score, then hours and ids."""
    shared = teaching_rows(detail, people, titles)
    order = [F.desc_nulls_last("score"), F.desc("hours"), F.asc("section_id"), F.asc("audience"), F.asc("person_id"),
             F.asc("course_code"), F.asc("students")]
    return rank_in(shared, ["college", "year", "term"], order, "place")


def teaching_summary(load: DataFrame, more: Mapping[str, Column] | None = None) -> DataFrame:
    """Hours per college, audience and year in blocks by title, gender and age; courses by score band.

    `more` adds blocks, by talent programme or track, say.  The workload is read twice, so the columns
    needed are written once.
    """
    keys = ["college", "audience", "year"]
    extra = {tag: (f"_m{n}", c) for n, (tag, c) in enumerate((more or {}).items())}
    load = scale.written(load.select(*keys, "title", "gender", "age", "score", "hours_share", "section_id",
                                     *[c.alias(name) for name, c in extra.values()]))
    age = bucket("age", [30, 40, 50, 60], ["under 30", "30-39", "40-49", "50-59", "60 up"], "60 up")
    blocks = {"all": F.lit("0"), "title": F.col("title"), "gender": F.col("gender"), "age": age}
    blocks |= {tag: F.col(name) for tag, (name, _) in extra.items()}
    hours = long_summary(load, keys, blocks, {"hours": F.col("hours_share")})
    score = bucket("score", [70, 80, 90], ["under 70", "70-79", "80-89", "90 up"], "unscored")
    courses = long_summary(load, keys, {"score": score}, {"hours": F.lit(0).cast("decimal(20,2)")}, "section_id",
                           "n_courses")
    return union_layouts([hours.withColumn("n_courses", F.lit(0).cast("long")), courses], distinct=False)


def course_detail(teaching: DataFrame, people: DataFrame, only: Column | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Distinct teacher names per college, course and term, with the calendar year of the term.

    teaching: person_id, course_code, year, term; people: person_id, college, name.  `only`
    restricts to some people (professors, say).
    """
    chosen = people if only is None else people.filter(only)
    rows = teaching.join(chosen.select("person_id", "college", "name"), "person_id")
    keys = ["college", "course_code", "year", "term"]
    return concat_group(rows, keys, "name", distinct=True, out="teachers", part_rows=part_rows).withColumn(
        "calendar_year", calendar_year("year", "term"))


def teaching_feed(views: Mapping[str, DataFrame], keys: list[str]) -> tuple[DataFrame, Gate]:
    """Register the source views, stack them into the feed and check that its key is unique."""
    frames = [register_view(df, name) for name, df in views.items()]
    feed = union_layouts(frames, distinct=False)
    doubled = unique_violations(feed, keys).count()
    return feed, Gate(doubled == 0, doubled, "ok" if doubled == 0 else "key is not unique")
