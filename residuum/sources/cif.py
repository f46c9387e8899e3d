"""Macromolecular CIF text: tables of any category, atoms, header and chain sequences.

A file is the unit that Spark deals out; a small tokenizer turns it into the rows of the
wanted category, and all further work is on columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A text field between lines that begin with a semicolon, a quoted word that white space ends, a comment, or a word.
TOKEN = re.compile(r"""^;(?P<text>.*?)^;(?=\s|\Z)|'(?P<one>(?:[^'\n]|'(?=\S))*)'(?=\s|\Z)|"(?P<two>(?:[^"\n]|"(?=\S))*)"(?=\s|\Z)|\#[^\n]*|(?P<word>\S+)""", re.MULTILINE | re.DOTALL)
ATOM = {
    "group_PDB": "record", "id": "serial", "label_atom_id": "atom", "auth_atom_id": "_atom", "label_alt_id": "alt", "label_comp_id": "res_name", "auth_comp_id": "_res_name", "label_asym_id": "chain_label", "auth_asym_id": "chain",
    "auth_seq_id": "res_num", "label_seq_id": "_seq", "pdbx_PDB_ins_code": "ins_code", "Cartn_x": "x", "Cartn_y": "y", "Cartn_z": "z", "B_iso_or_equiv": "b_factor", "type_symbol": "element", "pdbx_PDB_model_num": "model",
}


def tokens(text: str) -> Iterator[tuple[bool, str]]:
    """(is a bare word, value) of each token; line ends of text fields are kept but for the last."""
    for m in TOKEN.finditer(text):
        kind = m.lastgroup
        if kind == "text":
            yield False, m["text"].removesuffix("\n")
        elif kind:
            yield kind == "word", m[kind]


def category_rows(text: str, category: str, columns: list[str]) -> list[tuple]:
    """Rows of a category, of loops and single items alike; missing columns and the marks ``?`` and ``.`` are null.

    A loop that ends within a row loses that row; a data block that follows another adds its rows.
    """
    prefix, rows, single = f"_{category.lower()}.", [], {}
    names: list[str] | None = None
    values: list = []

    def close():
        nonlocal names, values
        if names and names[0].startswith(prefix):
            places = [names.index(prefix + c.lower()) if prefix + c.lower() in names else -1 for c in columns]
            for low in range(0, len(values) - len(names) + 1, len(names)):
                row = values[low : low + len(names)]
                rows.append(tuple(None if p < 0 else row[p] for p in places))
        names, values = None, []

    def flush():
        if single:
            rows.append(tuple(single.get(c.lower()) for c in columns))
            single.clear()

    item, heading = None, False
    for bare, value in tokens(text):
        low = value.lower() if bare else ""
        if low == "loop_":
            close()
            names, heading, item = [], True, None
        elif low.startswith(("data_", "save_")) or low in ("global_", "stop_"):
            close()
            flush()
            item = None
        elif bare and low.startswith("_"):
            if names is not None and heading:
                names.append(low)
            else:
                close()
                item = low
        else:
            value = None if bare and value in ("?", ".") else value
            if names is not None:
                heading = False
                values.append(value)
            elif item is not None:
                if item.startswith(prefix):
                    single[item[len(prefix) :]] = value
                item = None
    close()
    flush()
    return rows


def parse_category(texts: DataFrame, keys: list[str], category: str, columns: list[str], text: str = "value") -> DataFrame:
    """(keys, row, columns as text) of a category in CIF texts (keys, text); a null text has no rows."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*keys).schema.fields)

    def run(batches):
        for batch in batches:
            for i, value in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                rows = category_rows(value, category, columns) if value else []
                if rows:
                    own = [pa.concat_arrays([c.slice(i, 1)] * len(rows)) for c in batch.columns[:-1]]
                    cells = [pa.array(x, pa.string()) for x in zip(*rows)]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(range(len(rows)), pa.int64()), *cells], names=[*keys, "row", *columns])

    return texts.select(*keys, text).mapInArrow(run, f"{fields}, row long, " + ", ".join(f"`{c}` string" for c in columns))


def parse_atoms(texts: DataFrame, keys: list[str], text: str = "value") -> DataFrame:
    """Atoms of CIF texts with the columns of those from fixed-width lines: the first model, the first alternate place.

    Names and chains are the author's where given, else the labels.
    """
    rows = parse_category(texts, keys, "atom_site", list(ATOM), text)
    rows = rows.select(*keys, "row", *(F.col(c).alias(name) for c, name in ATOM.items()))
    first = F.first("model", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_first", first).where((F.col("model").isNull() | (F.col("model") == F.col("_first"))) & (F.col("alt").isNull() | F.col("alt").isin("A", "1")))
    return rows.select(
        *keys, F.coalesce("record", F.lit("ATOM")).alias("record"), F.col("serial").try_cast("int").alias("serial"), F.coalesce("_atom", "atom").alias("atom"), F.coalesce("_res_name", "res_name").alias("res_name"), F.coalesce("chain", "chain_label").alias("chain"),
        F.coalesce("res_num", "_seq").try_cast("int").alias("res_num"), F.coalesce("ins_code", F.lit("")).alias("ins_code"), *(F.col(c).try_cast("double").alias(c) for c in ("x", "y", "z", "b_factor")), "element",
    )


def resolution(texts: DataFrame, keys: list[str], text: str = "value") -> DataFrame:
    """(keys, resolution): the least that refinement, reconstruction or reflections state; null if none does."""
    stated = [("refine", "ls_d_res_high"), ("em_3d_reconstruction", "resolution"), ("reflns", "d_resolution_high")]
    found = None
    for category, column in stated:
        rows = parse_category(texts, keys, category, [column], text).select(*keys, F.col(column).try_cast("double").alias("r"))
        found = rows if found is None else found.unionByName(rows)
    return texts.select(*keys).join(found.groupBy(*keys).agg(F.min("r").alias("resolution")), keys, "left")


def read_cif(spark: SparkSession, path: str) -> DataFrame:
    """(file, value) of each CIF file, also compressed ones, by Spark's text reader."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
