"""Hierarchy paths.

A path ``A > B > C`` becomes Level1..LevelN by array position (deterministic, no shuffle) instead of
numbering exploded rows with an unordered ROW_NUMBER (Q19)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The path separator as written and as split, and the default number of levels.
PATH_JOIN = " > "
PATH_SPLIT = ">"
MAX_LEVELS = 8


def hierarchy_path(*cols, sep: str = PATH_JOIN) -> Column:
    """concat_ws: NULL parts are skipped."""
    return F.concat_ws(sep, *[F.col(c) if isinstance(c, str) else c for c in cols])


def level_array(path, sep: str = PATH_SPLIT) -> Column:
    path = F.col(path) if isinstance(path, str) else path
    return F.transform(F.split(path, sep), lambda x: F.trim(x))


def level_columns(path, max_levels: int = MAX_LEVELS, prefix: str = "Level", sep: str = PATH_SPLIT,
                  with_depth: bool = False, with_all: bool = False) -> list[Column]:
    """Level1..LevelN. ``with_all`` adds ``Levels``, the trimmed levels joined by the path separator, which loses none
    however deep the path is; ``with_depth`` adds their number."""
    arr = level_array(path, sep)
    cols = [F.try_element_at(arr, F.lit(i)).alias(f"{prefix}{i}") for i in range(1, max_levels + 1)]
    if with_depth:
        cols.append(F.size(arr).alias("depth"))
    if with_all:
        cols.append(F.array_join(arr, PATH_JOIN).alias("Levels"))
    return cols


def explode_levels(df: DataFrame, id_col: str, path: str, sep: str = PATH_SPLIT) -> DataFrame:
    """(id, position 1.., trimmed level); rows with a NULL path produce nothing, like explode."""
    return df.select(F.col(id_col), F.posexplode(F.split(F.col(path), sep)).alias("pos", "level")) \
             .select(id_col, (F.col("pos") + 1).alias("position"), F.trim("level").alias("level"))


def pivot_levels_grouped(exploded: DataFrame, id_col: str, max_levels: int = MAX_LEVELS,
                         prefix: str = "Level") -> DataFrame:
    """The group-by form: MAX(CASE WHEN position = n THEN level END) per id."""
    return exploded.groupBy(id_col).agg(*[
        F.max(F.when(F.col("position") == i, F.col("level"))).alias(f"{prefix}{i}")
        for i in range(1, max_levels + 1)])
