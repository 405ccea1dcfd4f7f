"""Word pattern and intermediate tables shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterflow.plans.storage import delete_at_end, delete_folder, new_folder

# The white space that separates words: blank, tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN)
    )


class Stored:
    """A table written to the shared folder: lineage ends here, lost executors only re-read.

    ``table`` reads it back; ``drop()`` removes the files when no later step needs them. What is not
    dropped goes when the driver's JVM ends.
    """

    def __init__(self, table: DataFrame, name: str = "step"):
        self._spark = table.sparkSession
        self.path = new_folder(self._spark, name)
        table.write.parquet(self.path)
        delete_at_end(self._spark, self.path)
        self.table = self._spark.read.schema(table.schema).parquet(self.path)

    def drop(self) -> None:
        delete_folder(self._spark, self.path)
