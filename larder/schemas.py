"""Fixed schemas of the tables the jobs read and write."""

from pyspark.sql import types as T


def _nullable(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# Column names, order and types of the stored tables.
RAW_RECIPE = _nullable(
    name=T.StringType(),
    ingredients=T.StringType(),
    datePublished=T.StringType(),
    cookTime=T.StringType(),
    prepTime=T.StringType(),
    description=T.StringType(),
    image=T.StringType(),
    recipeYield=T.StringType(),
    url=T.StringType(),
)

CLEANSED_RECIPE = _nullable(
    recipeName=T.StringType(),
    datePublished=T.DateType(),
    cookTimeMinutes=T.IntegerType(),
    prepTimeMinutes=T.IntegerType(),
    description=T.StringType(),
    image=T.StringType(),
    recipeYield=T.StringType(),
    url=T.StringType(),
    ingredients_arr=T.ArrayType(T.StringType(), True),
    year=T.IntegerType(),
    month=T.IntegerType(),
)

DIFFICULTY_REPORT = _nullable(
    difficulty=T.StringType(),
    avg_total_cooking_time=T.DoubleType(),
)

RUN_HISTORY = _nullable(
    id=T.LongType(),
    etl_name=T.StringType(),
    skip_execution=T.StringType(),
    is_active=T.StringType(),
    full_load=T.StringType(),
    run_date=T.TimestampType(),
    filter_col1_name=T.StringType(),
    filter_col1_value=T.StringType(),
    filter_col2_name=T.StringType(),
    filter_col2_value=T.StringType(),
)

INPUT_FILE = _nullable(
    path=T.StringType(),
    length=T.LongType(),
    modified=T.TimestampType(),
    full_load=T.StringType(),
    run_id=T.LongType(),
)

RUN_PROFILE = _nullable(
    column=T.StringType(),
    rows=T.LongType(),
    nulls=T.LongType(),
    different=T.BinaryType(),
    numbers=T.BinaryType(),
    full_load=T.StringType(),
    run_id=T.LongType(),
)

REPORT_STATE = _nullable(
    difficulty=T.StringType(),
    minutes=T.LongType(),
    timed=T.LongType(),
    recipes=T.LongType(),
    year=T.IntegerType(),
    month=T.IntegerType(),
)
