"""Files as tables: rule files, CSV ledgers, snapshot tables, library folders, archive and sheet cards."""

from __future__ import annotations

import io
import re
import zipfile
from pathlib import Path
from xml.parsers import expat

import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.cards import extension_counts, text_card
from ledgerloom.functions.hashing import page_hash

SKIPPED_FOLDERS = {".library", "snapshots", ".git"}


def load_yaml(path: str | Path, default: object = None) -> object:
    """A YAML file; the default if it is missing or empty."""
    file = Path(path)
    return (yaml.safe_load(file.read_text(encoding="utf-8")) or default) if file.exists() else default


def starter_profiles(folder: str | Path) -> dict[str, dict]:
    """Profiles of a folder by file name, in order."""
    return {p.stem: load_yaml(p, {}) for p in sorted(Path(folder).glob("*.yaml"))} if Path(folder).is_dir() else {}


def site_settings(path: str | Path) -> dict:
    """Site settings, which must exist: areas, resource types, snapshot paths, and the cadence (30 days unless stated)."""
    written = load_yaml(path)
    if not written:
        raise FileNotFoundError(f"no site settings in {path}")
    return {"areas": [], "resource_types": [], "snapshots": [], "rescan_after_days": 30, **written}


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV ledger with all columns as text: quotes doubled, line breaks in cells, empty cells as ''. Missing file: no rows."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path).na.fill("")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV for people: rows in order of the whole row as text, over as many files as the table needs, whose names are in order too."""
    text = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    text.orderBy(*text.columns).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").option("lineSep", "\n").csv(path)


def read_snapshot_tables(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV tables in long form: table_name, row_no, col_no, header, value. Each file is read whole by one task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(path).select("path", "content")

    def cells(batches):  # noqa: ANN001, ANN202
        import csv

        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"]):
                lines = list(csv.reader(io.StringIO(content.decode("utf-8", "replace"), newline="")))
                head = [h or f"col {i}" for i, h in enumerate(lines[0], 1)] if lines else []
                for r, line in enumerate(lines[1:]):
                    rows += [(name.rsplit("/", 1)[-1], r, c, head[c] if c < len(head) else f"col {c + 1}", v) for c, v in enumerate(line)]
            yield pd.DataFrame(rows, columns=["table_name", "row_no", "col_no", "header", "value"])

    return files.mapInPandas(cells, "table_name string, row_no int, col_no int, header string, value string")


def snapshot_hashes(spark: SparkSession, path: str) -> DataFrame:
    """name, hash of the snapshot pages (Markdown files) below a folder, blind to their generated headers."""
    pages = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").option("recursiveFileLookup", True).load(path)
    return pages.select(F.regexp_extract("path", r"([^/]*)\.md$", 1).alias("name"), page_hash(F.decode("content", "UTF-8")).alias("hash"))


def load_lock(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A library's lock; an empty one where there is none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    held = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(schema).json(path) if held else spark.createDataFrame([], schema)


def save_lock(lock: DataFrame, path: str) -> None:
    """The lock as JSON lines in order of path."""
    lock.orderBy("path").write.mode("overwrite").json(path)


def library_files(spark: SparkSession, root: str) -> DataFrame:
    """path (relative), sha256, bytes of a library's files, without its own folders and hidden top-level names."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = re.escape(str(root).rstrip("/"))
    relative = F.regexp_replace(F.col("path"), f"^(?:[a-z]+:/*)?/*{base.lstrip('/')}/", "")
    first = F.split_part(relative, F.lit("/"), F.lit(1))
    inside = F.exists(F.split(relative, "/"), lambda s: s.isin(*SKIPPED_FOLDERS))
    return files.where(~inside & ~first.startswith(".")).select(relative.alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


CONTENTS = "names array<string>, sheets array<string>, text string, error string"


def archive_members(content: bytes | None) -> list[zipfile.ZipInfo]:
    """The files of an archive in its own order, without folders and what some systems add beside them."""
    with zipfile.ZipFile(io.BytesIO(content or b"")) as archive:
        return [m for m in archive.infolist() if not m.is_dir() and m.filename.split("/")[0] != "__MACOSX"]


def workbook_sheets(content: bytes | None) -> list[str]:
    """Sheet names of a workbook in order, read from its list of sheets as XML."""
    with zipfile.ZipFile(io.BytesIO(content or b"")) as book, book.open("xl/workbook.xml") as listed:
        reader = expat.ParserCreate(namespace_separator=" ")
        names: list[str] = []
        reader.StartElementHandler = lambda tag, attrs: names.append(attrs.get("name", "")) if tag.split(" ")[-1] == "sheet" else None
        reader.ParseFile(listed)
    return names


def contents_of(kind: str, content: bytes | None) -> tuple[list[str] | None, list[str] | None, str, str | None]:
    """names, sheets, text, error of one file; what cannot be opened says why and has no text."""
    names = sheets = None
    try:
        if kind == "zip":
            names = [m.filename for m in archive_members(content)]
        elif kind == "xlsx":
            sheets = workbook_sheets(content)
        elif kind in ("txt", "md"):
            return None, None, (content or b"").decode("utf-8", "replace"), None
    except (zipfile.BadZipFile, KeyError, OSError, ValueError, expat.ExpatError) as e:
        return None, None, "", f"{type(e).__name__}: {e}"
    return names, sheets, "".join(f"{line}\n" for line in names or sheets or []), None


def file_cards(files: DataFrame, path: str = "path", content: str = "content", sampled: int = 25) -> DataFrame:
    """path, card(type, entries, by_extension, sample, sheets, text, error), and the features of the card's text.

    Only the opening of a file is Python; everything the card says about its contents is counted here. PDF text is read
    elsewhere and comes in as .txt, or page by page through `page_card`.
    """

    @F.pandas_udf(CONTENTS)
    def opened(kinds: pd.Series, contents: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([contents_of(k, c) for k, c in zip(kinds, contents)], columns=["names", "sheets", "text", "error"])

    kind = F.lower(F.regexp_extract(F.col(path), r"[^/]\.([^./]+)$", 1))
    read = files.select(F.col(path).alias("path"), kind.alias("kind"), opened(kind, F.col(content)).alias("c"))
    names = F.col("c.names")
    card = F.struct(
        F.when(F.col("kind") == "", "unknown").otherwise(F.col("kind")).alias("type"),
        F.when(names.isNotNull(), F.size(names)).alias("entries"),
        F.when(names.isNotNull(), extension_counts(names)).alias("by_extension"),
        F.slice(names, F.lit(1), F.lit(sampled)).alias("sample"),
        F.col("c.sheets").alias("sheets"),
        F.col("c.text").alias("text"),
        F.col("c.error").alias("error"),
    )
    return read.select("path", card.alias("card"), text_card(F.col("c.text")).alias("features"))
