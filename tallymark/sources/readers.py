"""Sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table. A name that does not exist raises ``AnalysisException`` here, before any job starts."""
    return spark.table(name)


# Quotes are doubled, backslashes are ordinary, blanks stay, and moments keep their microseconds.
_FORMAT = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
REJECTED = "_rejected"


def _texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    names = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.withColumns({name: change(F.col(f"`{name}`")) for name in names})


def _escaped(text: Column) -> Column:
    """Line breaks and backslashes as two characters, so that a record is a line and files can be split anywhere.

    The empty text is written as two characters as well, to be told from NULL.
    """
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return F.when(text == "", r"\e").otherwise(text)


def _unescaped(text: Column) -> Column:
    def part(p: Column) -> Column:
        return F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    return F.when(text == r"\e", "").otherwise(F.array_join(F.transform(F.split(text, r"\\\\", -1), part), "\\"))


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | str, separator: str = ",", *, strict: bool = True
) -> DataFrame:
    """Delimited text as :func:`write_delimited` leaves it, with a declared schema: files are read once.

    A record that does not fit the schema raises; with ``strict=False`` its bad values are NULL, and
    :func:`rejected_lines` has the whole line.
    """
    reader = spark.read.schema(schema).options(**_FORMAT).option("sep", separator)
    return _texts(reader.option("mode", "FAILFAST" if strict else "PERMISSIVE").csv(path), _unescaped)


def _with_rejected(spark: SparkSession, path: str, schema: StructType | str, separator: str) -> DataFrame:
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.schema(StructType([*wanted, StructField(REJECTED, StringType())])).options(**_FORMAT)
    rows = reader.option("sep", separator).option("columnNameOfCorruptRecord", REJECTED).csv(path)
    # a line is rejected for any of its values, so all are read, whichever columns are asked for; this is always true
    return rows.filter(F.xxhash64(*(F.col(f"`{f.name}`") for f in wanted)) % 2 < 2)


def accepted_rows(spark: SparkSession, path: str, schema: StructType | str, separator: str = ",") -> DataFrame:
    """The records that fit the schema."""
    return _texts(_with_rejected(spark, path, schema, separator).filter(F.col(REJECTED).isNull()).drop(REJECTED), _unescaped)


def rejected_lines(spark: SparkSession, path: str, schema: StructType | str, separator: str = ",") -> DataFrame:
    """The lines that do not fit the schema, as they are, in the column ``_rejected`` beside what could be read."""
    return _with_rejected(spark, path, schema, separator).filter(F.col(REJECTED).isNotNull())


def write_delimited(df: DataFrame, path: str, separator: str = ",", *, mode: str = "errorifexists") -> None:
    """One line per row, whatever its texts hold; :func:`read_delimited` gives the same rows back."""
    _texts(df, _escaped).write.mode(mode).options(**_FORMAT).option("sep", separator).csv(path)


def create_delimited_table(spark: SparkSession, name: str, columns: str, separator: str = ",") -> None:
    """Empty catalog table stored as delimited text; ``columns`` is DDL such as ``id INT, name STRING``.

    A record that does not fit raises when it is read. The table takes texts without line breaks.
    """
    options = ", ".join(f"'{k}' '{v}'".replace("'T'", "\\'T\\'") for k, v in _FORMAT.items() if k != "lineSep")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING csv OPTIONS (sep '{separator}', mode 'FAILFAST', {options})"
    )
