"""The recipe jobs over recipe files that Spark writes from the documents."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from larder.operators import history as runs
from larder.operators import recipes
from larder.operators.digests import differing_groups, group_digests
from larder.operators.merge import latest_per_key
from larder.plans.recipes import (
    RecipeJob,
    ingest_recipes,
    load_apart,
    load_recipes,
    recipe_profiles,
    report_recipes,
    run_recipes,
    stored_recipes,
)
from larder.schemas import CLEANSED_RECIPE, DIFFICULTY_REPORT
from larder.sources.csv_report import read_csv_report
from larder.sources.history_table import HistoryTable
from larder.sources.lake import read_lake
from larder.sources.ledger import FileLedger
from larder.sources.profiles import merged_profiles
from larder.sources.quarantine import good_path, read_quarantined
from larder.sources.snapshots import expire_snapshots
from larder.sources.shared import scratch_path
from workload.registry import query, table

TERM = "license"
BATCH_END = "2012-06-30"

# The cleansed form of the recipes made from the documents below.
CLEANSED_SQL = r"""raw AS (SELECT *, n_chars % 1500 AS days, n_chars % 60 AS odd,
        CAST(source = 'src2' AS BOOLEAN) AS undated FROM documents),
    cleansed AS (SELECT CASE WHEN source = 'src1' THEN '' ELSE source || '-' || doc_id END AS recipeName,
        CASE WHEN NOT undated THEN DATE '2010-01-01' + CAST(days AS INTEGER) END AS datePublished,
        CAST(CASE WHEN source IN ('src3', 'src4') THEN NULL ELSE n_chars % 3 * 60 + odd END AS INTEGER)
            AS cookTimeMinutes,
        CAST(CASE WHEN source = 'src5' THEN 0 ELSE doc_id % 40 END AS INTEGER) AS prepTimeMinutes,
        lang AS description, 'https://img.example.com/' || doc_id AS image,
        CAST(n_chars % 12 AS VARCHAR) AS recipeYield, CAST(NULL AS VARCHAR) AS url,
        CASE WHEN lang <> 'de' THEN string_split(text, chr(10)) END AS ingredients_arr
    FROM raw WHERE source <> 'src0'),
    prepared AS (SELECT recipeName, datePublished, cookTimeMinutes + prepTimeMinutes AS total_time,
        CASE WHEN cookTimeMinutes + prepTimeMinutes < 30 THEN 'easy'
            WHEN cookTimeMinutes + prepTimeMinutes <= 60 THEN 'medium' ELSE 'hard' END AS difficulty,
        CAST(coalesce(len(list_filter(ingredients_arr, lambda x: contains(lower(x), 'license'))) > 0, false)
            AS INTEGER) AS mentions_term
    FROM cleansed)"""
FLAT_SQL = """SELECT recipeName, datePublished, cookTimeMinutes, prepTimeMinutes, description, image,
        recipeYield, url, array_to_string(ingredients_arr, '|') AS ingredients,
        CAST(year(datePublished) AS INTEGER) AS "year", CAST(month(datePublished) AS INTEGER) AS "month" FROM cleansed"""
REPORT_SQL = """SELECT difficulty, CAST(round(avg(total_time)) AS DOUBLE) AS avg_total_cooking_time
    FROM prepared GROUP BY difficulty"""


def raw_recipes(spark, sf_dir):
    """Recipes as they would arrive: padded names, free-form durations, some fields unusable."""
    n, source = F.col("n_chars"), F.col("source")
    name = F.when(source == "src1", "   ").when(
        source != "src0", F.concat(F.lit("  "), source, F.lit("-"), F.col("doc_id"), F.lit(" "))
    )
    date = F.date_add(F.lit("2010-01-01").cast("date"), (n % 1500).cast("int")).cast("string")
    cook = F.concat(F.lit("PT"), n % 3, F.lit("H"), n % 60, F.lit("M"))
    prep = F.concat(F.lit("PT"), F.col("doc_id") % 40, F.lit("M"))
    return table(spark, sf_dir, "documents").select(
        name.alias("name"),
        F.when(F.col("lang") != "de", F.col("text")).alias("ingredients"),
        F.when(source == "src2", "not-a-date").otherwise(date).alias("datePublished"),
        F.when(source == "src4", "PT1.5H").when(source != "src3", cook).alias("cookTime"),
        F.when(source == "src5", "PT").otherwise(prep).alias("prepTime"),
        F.col("lang").alias("description"),
        F.concat(F.lit("https://img.example.com/"), F.col("doc_id")).alias("image"),
        (n % 12).alias("recipeYield"),
        F.lit("unread").alias("keywords"),
    )


def flat(df):
    """The array as one text, so that results compare as plain values."""
    return df.select(
        *[name for name in df.columns if name != "ingredients_arr"],
        F.array_join("ingredients_arr", "|").alias("ingredients"),
    )


def recipe_files(spark, sf_dir):
    path = scratch_path(spark, "recipes")
    raw_recipes(spark, sf_dir).write.json(path)
    return path


def new_job(spark, input_path, **changes):
    folder = scratch_path(spark, "job")
    job = RecipeJob(
        input_path,
        lake_path=f"{folder}/lake",
        report_path=f"{folder}/report",
        history_path=f"{folder}/history",
        term=TERM,
        **changes,
    )
    HistoryTable(spark, job.history_path).seed(job.etl_name)
    return job


def in_two_batches(spark, sf_dir, **changes):
    """A job run over the recipes up to a date, over all of them, and over nothing new."""
    path = scratch_path(spark, "recipes")
    raw = raw_recipes(spark, sf_dir)
    early = F.col("datePublished") <= BATCH_END
    job = new_job(spark, path, **changes)
    raw.where(early).write.mode("append").json(path)
    ingest_recipes(spark, job)
    raw.where(~early).write.mode("append").json(path)
    ingest_recipes(spark, job)
    ingest_recipes(spark, job)
    return job


@query(f"WITH {CLEANSED_SQL} {FLAT_SQL}")
def cleanse_full(spark, sf_dir):
    return flat(load_recipes(spark, recipe_files(spark, sf_dir)))


@query(f"WITH {CLEANSED_SQL} {FLAT_SQL} WHERE datePublished > DATE '{BATCH_END}'")
def cleanse_delta(spark, sf_dir):
    return flat(load_recipes(spark, recipe_files(spark, sf_dir), BATCH_END))


@query(f"""WITH {CLEANSED_SQL} SELECT recipeName, mentions_term AS is_beef_recipe,
        CAST(total_time AS INTEGER) AS total_time, difficulty FROM prepared""")
def aggregation_input(spark, sf_dir):
    stored = load_recipes(spark, recipe_files(spark, sf_dir))
    return recipes.aggregation_input(stored, TERM)


@query(f"WITH {CLEANSED_SQL} SELECT recipeName FROM prepared WHERE mentions_term = 1")
def recipes_mentioning_term(spark, sf_dir):
    stored = load_recipes(spark, recipe_files(spark, sf_dir))
    return recipes.mentioning(stored, TERM)


@query(f"WITH {CLEANSED_SQL} {REPORT_SQL}")
def difficulty_report(spark, sf_dir):
    stored = load_recipes(spark, recipe_files(spark, sf_dir))
    return recipes.difficulty_report(recipes.aggregation_input(stored, TERM))


@query(f"WITH {CLEANSED_SQL} {REPORT_SQL.replace('GROUP BY', 'WHERE mentions_term = 1 GROUP BY')}")
def difficulty_report_of_matches(spark, sf_dir):
    stored = load_recipes(spark, recipe_files(spark, sf_dir))
    prepared = recipes.aggregation_input(stored, TERM)
    return recipes.difficulty_report(prepared, only=F.col("is_beef_recipe") == 1)


@query(f"WITH {CLEANSED_SQL} {FLAT_SQL}")
def ingest_full(spark, sf_dir):
    job = new_job(spark, recipe_files(spark, sf_dir))
    ingest_recipes(spark, job)
    return flat(read_lake(spark, job.lake_path, CLEANSED_RECIPE))


# A full load of the early files keeps no undated recipe here, and a delta drops them.
@query(f"WITH {CLEANSED_SQL} {FLAT_SQL} WHERE datePublished IS NOT NULL")
def ingest_delta(spark, sf_dir):
    job = in_two_batches(spark, sf_dir)
    return flat(read_lake(spark, job.lake_path, CLEANSED_RECIPE))


@query(f"WITH {CLEANSED_SQL} {FLAT_SQL} WHERE datePublished IS NOT NULL")
def ingest_delta_staged(spark, sf_dir):
    job = in_two_batches(spark, sf_dir, stage_by_run=True)
    return flat(read_lake(spark, job.lake_path, CLEANSED_RECIPE))


@query(f"""WITH {CLEANSED_SQL}, marks AS (SELECT CAST(max(datePublished) AS VARCHAR) AS last,
        CAST(max(datePublished) FILTER (WHERE datePublished <= DATE '{BATCH_END}') AS VARCHAR) AS early FROM cleansed)
    SELECT CAST(unnest([1, 2, 3, 4]) AS BIGINT) AS id, unnest(['Y', 'N', 'N', 'N']) AS full_load,
        unnest([NULL, early, last, last]) AS filter_col1_value FROM marks""")
def history_after_runs(spark, sf_dir):
    """Seed, full load, delta, and a delta without rows that leaves the watermark as it was."""
    job = in_two_batches(spark, sf_dir)
    rows = HistoryTable(spark, job.history_path).read()
    return rows.select("id", "full_load", "filter_col1_value")


@query(f"WITH {CLEANSED_SQL} {FLAT_SQL} WHERE datePublished > DATE '{BATCH_END}'")
def cleanse_delta_short_dates(spark, sf_dir):
    """Months and days of one digit and trailing text are dates as well."""
    path = scratch_path(spark, "recipes")
    date = F.col("datePublished").try_cast("date")
    short = F.coalesce(F.concat(F.date_format(date, "yyyy-M-d"), F.lit("T10:00:00")), F.col("datePublished"))
    raw_recipes(spark, sf_dir).withColumn("datePublished", short).write.json(path)
    return flat(load_recipes(spark, path, BATCH_END))


def with_late_rows(spark, sf_dir, **changes):
    """A job with a lookback, run three times; some rows of the window arrive after the first run."""
    path = scratch_path(spark, "recipes")
    raw = raw_recipes(spark, sf_dir)
    late = F.col("datePublished").between("2012-06-01", BATCH_END) & (F.col("recipeYield") % 3 == 0)
    first = (F.col("datePublished") <= BATCH_END) & ~late
    job = new_job(spark, path, lookback_days=30, **changes)
    raw.where(first).write.mode("append").json(path)
    ingest_recipes(spark, job)
    raw.where(~first).write.mode("append").json(path)
    ingest_recipes(spark, job)
    ingest_recipes(spark, job)
    return job


@query(f"WITH {CLEANSED_SQL} {FLAT_SQL} WHERE datePublished IS NOT NULL")
def ingest_delta_lookback(spark, sf_dir):
    job = with_late_rows(spark, sf_dir)
    return flat(read_lake(spark, job.lake_path, CLEANSED_RECIPE))


@query(f"WITH {CLEANSED_SQL} {REPORT_SQL.replace('GROUP BY', 'WHERE datePublished IS NOT NULL GROUP BY')}")
def lookback_then_report(spark, sf_dir):
    job = with_late_rows(spark, sf_dir)
    report_recipes(spark, job)
    return read_csv_report(spark, job.report_path, DIFFICULTY_REPORT)


@query(f"WITH {CLEANSED_SQL} {FLAT_SQL} WHERE datePublished IS NOT NULL")
def ingest_delta_new_files(spark, sf_dir):
    job = in_two_batches(spark, sf_dir, new_files_only=True)
    return flat(read_lake(spark, job.lake_path, CLEANSED_RECIPE))


@query(f"WITH {CLEANSED_SQL} {REPORT_SQL}")
def ingest_then_report(spark, sf_dir):
    job = new_job(spark, recipe_files(spark, sf_dir))
    run_recipes(spark, job)
    return read_csv_report(spark, job.report_path, DIFFICULTY_REPORT)


def in_three_batches(spark, sf_dir, run=ingest_recipes, **changes):
    """A job run after each of three batches of files, whose rows are of all dates and none, and over nothing new."""
    path = scratch_path(spark, "recipes")
    raw = raw_recipes(spark, sf_dir)
    job = new_job(spark, path, **changes)
    for batch in range(3):
        raw.where(F.crc32("image") % 3 == batch).write.mode("append").json(path)
        run(spark, job)
    run(spark, job)
    return job


@query(f"WITH {CLEANSED_SQL} {FLAT_SQL}")
def ingest_delta_ledger(spark, sf_dir):
    """Each file is loaded once, so late and undated rows get in as well."""
    job = in_three_batches(spark, sf_dir, ledger_path=scratch_path(spark, "ledger"))
    return flat(read_lake(spark, job.lake_path, CLEANSED_RECIPE))


@query("""SELECT unnest(['rows', 'runs', 'files read twice', 'files not read']) AS "measure",
        unnest([count(*) FILTER (WHERE source <> 'src0'), 4, 0, 0]) AS n FROM documents""")
def ledger_files_once(spark, sf_dir):
    """Over four runs no file is read twice, and none of those listed is left out."""
    job = in_three_batches(spark, sf_dir, ledger_path=scratch_path(spark, "ledger"))
    ledger = FileLedger(spark, job.ledger_path, job.input_path)
    per_file = ledger.loaded(job.etl_name, 5).groupBy("path").agg(F.count("*").alias("n"))

    def measure(name, df):
        return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("measure"), "n")

    return (
        measure("rows", read_lake(spark, job.lake_path, CLEANSED_RECIPE))
        .union(measure("runs", HistoryTable(spark, job.history_path).read().where("id > 1")))
        .union(measure("files read twice", per_file.where("n > 1")))
        .union(measure("files not read", ledger.unseen(job.etl_name, 5)))
    )


@query(f"WITH {CLEANSED_SQL} {FLAT_SQL}")
def ingest_snapshots(spark, sf_dir):
    """A full load and deltas in a snapshot, read through the history."""
    job = in_three_batches(spark, sf_dir, ledger_path=scratch_path(spark, "ledger"), snapshots=True)
    return flat(stored_recipes(spark, job))


@query(f"WITH {CLEANSED_SQL} {REPORT_SQL}")
def snapshots_then_report(spark, sf_dir):
    """A second full load takes the place of a snapshot of other rows, which is then deleted."""
    path = scratch_path(spark, "recipes")
    raw = raw_recipes(spark, sf_dir)
    job = new_job(spark, path, snapshots=True)
    raw.where(F.crc32("image") % 2 == 0).write.mode("append").json(path)
    ingest_recipes(spark, job)
    raw.where(F.crc32("image") % 2 == 1).write.mode("append").json(path)
    history = HistoryTable(spark, job.history_path)
    again = runs.seed(spark, job.etl_name, run_id=3)
    history.append(again)
    run_recipes(spark, job)
    expire_snapshots(history, job.etl_name, job.lake_path)
    return read_csv_report(spark, job.report_path, DIFFICULTY_REPORT)


# What a second batch says about the recipes again: a third of them later and cooked for five minutes, a fifth as they were.
MERGED_SQL = f"""{CLEANSED_SQL},
    versions AS (SELECT *, 1 AS batch FROM cleansed UNION ALL SELECT * EXCLUDE (later) REPLACE (
            CASE WHEN later THEN datePublished + 40 ELSE datePublished END AS datePublished,
            CAST(CASE WHEN later THEN 5 ELSE cookTimeMinutes END AS INTEGER) AS cookTimeMinutes), 2 AS batch
        FROM (SELECT *, CAST(split_part(image, '/', 4) AS BIGINT) % 3 = 0 AS later FROM cleansed)
        WHERE later OR CAST(split_part(image, '/', 4) AS BIGINT) % 5 = 0),
    merged AS (SELECT * FROM versions
        QUALIFY row_number() OVER (PARTITION BY image ORDER BY datePublished DESC NULLS LAST, batch DESC) = 1)"""


def with_corrections(spark, sf_dir):
    """A job that merges by image, over early recipes, then over the others and corrections, then over the same files again."""
    path = scratch_path(spark, "recipes")
    raw = raw_recipes(spark, sf_dir)
    job = new_job(spark, path, ledger_path=scratch_path(spark, "ledger"), merge_keys=("image",))
    number = F.element_at(F.split("image", "/"), -1).cast("bigint")
    early = F.col("datePublished") <= BATCH_END
    raw.where(early).write.mode("append").json(path)
    ingest_recipes(spark, job)
    later = F.date_add(F.col("datePublished").try_cast("date"), 40).cast("string")
    corrected = raw.where(number % 3 == 0).withColumn("datePublished", F.coalesce(later, "datePublished"))
    repeated = raw.where((number % 5 == 0) & (number % 3 != 0))
    corrected = corrected.withColumn("cookTime", F.lit("PT5M"))
    raw.where(~early).unionByName(corrected).unionByName(repeated).unionByName(repeated).write.mode("append").json(path)
    ingest_recipes(spark, job)
    corrected.write.mode("append").json(path)
    ingest_recipes(spark, job)
    return job


@query(f"WITH {MERGED_SQL} {FLAT_SQL.replace('FROM cleansed', 'FROM merged')}")
def ingest_merged(spark, sf_dir):
    """Corrected and repeated recipes replace the earlier ones of the same image, in other months as well."""
    return flat(stored_recipes(spark, with_corrections(spark, sf_dir)))


@query(f"""WITH {CLEANSED_SQL} SELECT description, max_by(recipeName, recipeName) AS "name",
        max(datePublished) AS datePublished FROM cleansed WHERE datePublished IS NOT NULL GROUP BY description""")
def latest_per_language(spark, sf_dir):
    """One row of each of four keys, each of which a large share of the rows has."""
    stored = load_recipes(spark, recipe_files(spark, sf_dir))
    latest = latest_per_key(stored.where("datePublished IS NOT NULL"), ["description"], ["recipeName"])
    dates = stored.groupBy("description").agg(F.max("datePublished").alias("datePublished"))
    return latest.select("description", F.col("recipeName").alias("name")).join(dates, "description")


@query(f"WITH {CLEANSED_SQL} {REPORT_SQL}")
def report_incremental(spark, sf_dir):
    """The report after four runs, each of which summed up only the months it wrote."""
    paths = {"ledger_path": scratch_path(spark, "ledger"), "state_path": scratch_path(spark, "state")}
    job = in_three_batches(spark, sf_dir, run_recipes, **paths)
    return read_csv_report(spark, job.report_path, DIFFICULTY_REPORT)


@query(f"WITH {CLEANSED_SQL} {FLAT_SQL}")
def ingest_reconciled(spark, sf_dir):
    """Batches whose rows are of all dates and none: each delta replaces the months that differ from the input."""
    return flat(stored_recipes(spark, in_three_batches(spark, sf_dir, reconcile=True)))


# What the images' numbers say about the rows that are missing from the older table, and those that are changed there.
@query(f"""WITH {CLEANSED_SQL}, numbered AS (SELECT year(datePublished) AS y, month(datePublished) AS m,
        CAST(split_part(image, '/', 4) AS BIGINT) % 97 AS n FROM cleansed)
    SELECT CAST(y AS INTEGER) AS "year", CAST(m AS INTEGER) AS "month", count(*) AS "rows", count(*) FILTER (WHERE n <> 5) AS old_rows
    FROM numbered GROUP BY y, m HAVING count(*) FILTER (WHERE n IN (5, 11)) > 0""")
def months_that_differ(spark, sf_dir):
    """Months of which an older table lacks rows or has other ones, found by their digests."""
    new = load_recipes(spark, recipe_files(spark, sf_dir))
    number = F.element_at(F.split("image", "/"), -1).cast("bigint") % 97
    old = new.where(number != 5).withColumn("url", F.when(number == 11, "elsewhere").otherwise(F.col("url")))
    return differing_groups(new, old, ["year", "month"])


@query(f"""WITH {CLEANSED_SQL} SELECT CAST(year(datePublished) AS INTEGER) AS "year", count(*) AS "rows" FROM cleansed
    GROUP BY ALL""")
def digests_of_copies(spark, sf_dir):
    """Tables of the same rows in another order and layout have the same digests, so all groups are found in both."""
    stored = load_recipes(spark, recipe_files(spark, sf_dir))
    moved = stored.repartition(7, "image")
    digests = [group_digests(df, ["year"]) for df in (stored, moved)]
    return digests[0].intersect(digests[1]).select("year", "rows")


@query(f"WITH {CLEANSED_SQL} {FLAT_SQL}")
def ingest_two_attempts(spark, sf_dir):
    """Two attempts at each run at the same time; only one of them loads its files."""

    def twice(spark, job):
        with ThreadPoolExecutor(2) as pool:
            list(pool.map(lambda attempt: ingest_recipes(spark, job), range(2)))

    job = in_three_batches(
        spark, sf_dir, twice, ledger_path=scratch_path(spark, "ledger"), claims_path=scratch_path(spark, "claims")
    )
    return flat(stored_recipes(spark, job))


@query(f"""WITH {CLEANSED_SQL}, long AS (UNPIVOT (SELECT 1 AS one, coalesce(recipeName, '') AS recipeName,
        coalesce(CAST(datePublished AS VARCHAR), '-') AS datePublished, coalesce(CAST(cookTimeMinutes AS VARCHAR), '-') AS cookTimeMinutes,
        coalesce(CAST(prepTimeMinutes AS VARCHAR), '-') AS prepTimeMinutes FROM cleansed)
        ON recipeName, datePublished, cookTimeMinutes, prepTimeMinutes INTO NAME "column" VALUE v)
    SELECT "column", 3 AS runs, count(*) AS "rows", count(*) FILTER (WHERE v = '-') AS nulls,
        CAST("column" IN ('recipeName', 'datePublished') AS INTEGER) AS distinct_near,
        CAST("column" IN ('cookTimeMinutes', 'prepTimeMinutes') AS INTEGER) AS quantiles_near FROM long GROUP BY ALL""")
def profile_of_runs(spark, sf_dir):
    """Profiles of three runs added up: exact counts, and sketches as near the exact values as is stated for them."""
    paths = {"ledger_path": scratch_path(spark, "ledger"), "profiles_path": scratch_path(spark, "profiles")}
    job = in_three_batches(spark, sf_dir, **paths)
    # The fourth run had nothing to load; its profile, of no rows, is left out here.
    merged = merged_profiles(recipe_profiles(spark, job).stored(job.etl_name, 4))
    stored = read_lake(spark, job.lake_path, CLEANSED_RECIPE)
    names = ("recipeName", "datePublished", "cookTimeMinutes", "prepTimeMinutes")
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value")) for n in names)))
    exact = stored.select(each.alias("c")).select("c.*").groupBy("name").agg(F.countDistinct("value").alias("exact"))
    values = stored.select(each.alias("c")).select("c.name", F.col("c.value").try_cast("bigint").alias("value"))
    joined = values.join(F.broadcast(merged), F.col("name") == F.col("column"))
    near = F.lit(True)
    for i, rank in enumerate((0.25, 0.5, 0.75)):
        quantile = F.element_at("quantiles", i + 1)
        below = F.avg(F.when(F.col("value").isNotNull(), (F.col("value") < quantile).cast("int")))
        upto = F.avg(F.when(F.col("value").isNotNull(), (F.col("value") <= quantile).cast("int")))
        near &= (below <= rank + 0.01) & (upto >= rank - 0.01)
    placed = joined.groupBy("name").agg(F.coalesce(near, F.lit(False)).cast("int").alias("quantiles_near"))
    close = F.coalesce(F.abs(F.col("different") - F.col("exact")) <= 0.05 * F.col("exact"), F.lit(False)).cast("int")
    # Four rows a side, one per column.
    found = merged.join(F.broadcast(exact), F.col("column") == F.col("name")).drop("name").join(F.broadcast(placed), F.col("column") == F.col("name"))
    return found.select("column", F.col("runs").cast("int").alias("runs"), "rows", "nulls", close.alias("distinct_near"), "quantiles_near")


def apart(spark, sf_dir):
    """Recipe files, some lines of which are cut off, written with the unusable ones aside."""
    path, table_path = scratch_path(spark, "lines"), scratch_path(spark, "apart")
    raw = raw_recipes(spark, sf_dir)
    line = F.to_json(F.struct(*raw.columns))
    cut = F.when(F.element_at(F.split("image", "/"), -1).cast("bigint") % 10 == 7, F.substring(line, 1, 20)).otherwise(line)
    raw.select(cut.alias("value")).write.text(path)
    load_apart(spark, path, table_path)
    return table_path


@query("""SELECT CASE WHEN doc_id % 10 = 7 THEN 'line' WHEN source = 'src0' THEN 'name' WHEN source = 'src2' THEN 'date'
        WHEN source = 'src4' THEN 'duration' ELSE 'good' END AS reason, count(*) AS n FROM documents GROUP BY ALL""")
def quarantined_reasons(spark, sf_dir):
    """All lines read, good ones and those put aside by their reason."""
    path = apart(spark, sf_dir)
    aside = read_quarantined(spark, path, CLEANSED_RECIPE).where("line IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))
    good = read_lake(spark, good_path(path), CLEANSED_RECIPE).agg(F.count("*").alias("n"))
    return aside.union(good.select(F.lit("good").alias("reason"), "n"))


@query(f"""WITH {CLEANSED_SQL} {FLAT_SQL} WHERE CAST(split_part(image, '/', 4) AS BIGINT) % 10 <> 7
    AND NOT (datePublished IS NULL) AND NOT starts_with(recipeName, 'src4-')""")
def quarantine_good(spark, sf_dir):
    """What stays when unusable lines are put aside."""
    return flat(read_lake(spark, good_path(apart(spark, sf_dir)), CLEANSED_RECIPE))
