"""Shredding nested JSON values into relational rows.

A nested column may arrive as JSON text (raw bronze) or already typed (typed bronze, the
preferred layout: the JSON is parsed once at read time and Parquet prunes nested fields).
Every operator accepts both: text is parsed with ``from_json`` against the declared type.

Semantics follow a lateral ``OPENJSON ... WITH`` apply:
- an array gives one row per element, a lone object counts as a one-element array,
- a NULL or empty array gives no rows (``outer=True`` keeps the parent with NULLs instead),
- missing fields become NULL, unknown fields are dropped.

All operators are narrow (no shuffle): ``Generate`` runs inside the scan's stage.

JSON text is parsed exactly once. An inner ``explode`` makes Catalyst infer a
``isnotnull(x) AND size(x) > 0`` filter and push it below the projection, which would repeat
``from_json`` (and, under a repartition, run it before the repartition on few tasks). So the
operators use the ``_outer`` generators, which infer nothing, and drop the empty rows with a
filter on the generator's output, which cannot move below the generator.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_type(dtype: T.DataType | str) -> T.DataType:
    if isinstance(dtype, str):
        return T._parse_datatype_string(dtype)
    return dtype


def typed(df: DataFrame, col: str, dtype: T.DataType | str) -> Column:
    """The column as ``dtype``: parsed with ``from_json`` when it is JSON text."""
    dtype = _as_type(dtype)
    if isinstance(df.schema[col].dataType, T.StringType) and not isinstance(dtype, T.StringType):
        return F.from_json(F.col(col), dtype)
    return F.col(col)


def _keep_cols(keep: Sequence[str] | Mapping[str, str] | None) -> list[Column]:
    if not keep:
        return []
    if isinstance(keep, Mapping):
        return [F.col(src).alias(dst) for src, dst in keep.items()]
    return [F.col(k) for k in keep]


def explode_objects(df: DataFrame, col: str, schema: T.StructType | str | None = None,
                    keep: Sequence[str] | Mapping[str, str] = (),
                    rename: Mapping[str, str] | None = None, outer: bool = False,
                    pos_alias: str | None = None) -> DataFrame:
    """One row per object of an array-of-objects column.

    ``schema`` is the element struct; when ``col`` is JSON text it is parsed as
    ``array<schema>`` (which also accepts a lone object). ``rename`` maps element fields to
    output names; fields not named in ``rename`` keep their names. ``pos_alias`` adds the
    0-based element position.
    """
    if schema is not None:
        arr = typed(df, col, T.ArrayType(_as_type(schema)))
    else:
        arr = F.col(col)
    exploded = df.select(*_keep_cols(keep), F.posexplode_outer(arr).alias("__pos", "__elem"))
    if not outer:
        exploded = exploded.where(F.col("__pos").isNotNull())
    elem_type = exploded.schema["__elem"].dataType
    fields = [f.name for f in elem_type.fields]
    rename = dict(rename or {})
    out = _keep_cols([c for c in exploded.columns if c not in ("__pos", "__elem")])
    if pos_alias:
        out.append(F.col("__pos").alias(pos_alias))
    out += [F.col("__elem").getField(f).alias(rename.get(f, f)) for f in fields]
    return exploded.select(*out)


def explode_scalars(df: DataFrame, col: str, elem_type: T.DataType | str = "string",
                    keep: Sequence[str] | Mapping[str, str] = (), alias: str = "value",
                    lower: bool = False, pos_alias: str | None = None,
                    outer: bool = False) -> DataFrame:
    """K5-K7, K9: one row per element of an array of scalars (duplicates kept).

    JSON numbers parse into strings and back; NULL elements are kept as NULL rows.
    """
    arr = typed(df, col, T.ArrayType(_as_type(elem_type)))
    exploded = df.select(*_keep_cols(keep), F.posexplode_outer(arr).alias("__pos", "__val"))
    if not outer:
        exploded = exploded.where(F.col("__pos").isNotNull())
    val = F.lower(F.col("__val")) if lower else F.col("__val")
    out = _keep_cols([c for c in exploded.columns if c not in ("__pos", "__val")])
    if pos_alias:
        out.append(F.col("__pos").alias(pos_alias))
    out.append(val.alias(alias))
    return exploded.select(*out)


def explode_entries(df: DataFrame, col: str, value_schema: T.DataType | str,
                    keep: Sequence[str] | Mapping[str, str] = (), key_alias: str = "key",
                    rename: Mapping[str, str] | None = None, outer: bool = False) -> DataFrame:
    """An object with open keys to rows of (key, value fields).

    ``col`` is ``map<string, value_schema>`` or JSON text of such an object. Struct values
    are flattened into columns (``rename`` maps field names); scalar values land in
    ``value``. Duplicate JSON keys keep the last value.
    """
    mtype = T.MapType(T.StringType(), _as_type(value_schema))
    m = typed(df, col, mtype)
    exploded = df.select(*_keep_cols(keep), F.explode_outer(m).alias("__key", "__value"))
    if not outer:
        exploded = exploded.where(F.col("__key").isNotNull())  # map keys are never NULL
    out = _keep_cols([c for c in exploded.columns if c not in ("__key", "__value")])
    out.append(F.col("__key").alias(key_alias))
    vtype = exploded.schema["__value"].dataType
    rename = dict(rename or {})
    if isinstance(vtype, T.StructType):
        out += [F.col("__value").getField(f.name).alias(rename.get(f.name, f.name)) for f in vtype.fields]
    else:
        out.append(F.col("__value").alias(rename.get("value", "value")))
    return exploded.select(*out)


def flatten_struct(df: DataFrame, col: str, mapping: Mapping[str, str] | Sequence[str] | None = None,
                   keep: Sequence[str] | Mapping[str, str] = (), schema: T.StructType | str | None = None,
                   require_present: bool = True) -> DataFrame:
    """Project fields of one object column into columns.

    ``mapping`` maps nested paths (``"images.symbol"``) to output names; a plain list keeps the
    leaf names. With ``require_present`` a NULL object gives no row (lateral-apply semantics).
    """
    obj = typed(df, col, schema) if schema is not None else F.col(col)
    parsed = schema is not None and isinstance(df.schema[col].dataType, T.StringType)
    if require_present and parsed:
        # Parse once inside a generator; the presence filter then stays above it.
        base = df.select(*_keep_cols(keep), F.explode_outer(F.array(obj)).alias("__obj"))
    else:
        base = df.select(*_keep_cols(keep), obj.alias("__obj"))
    if require_present:
        base = base.where(F.col("__obj").isNotNull())
    if mapping is None:
        mapping = [f.name for f in base.schema["__obj"].dataType.fields]
    if not isinstance(mapping, Mapping):
        mapping = {p: p.split(".")[-1] for p in mapping}
    out = _keep_cols([c for c in base.columns if c != "__obj"])
    for path, name in mapping.items():
        c = F.col("__obj")
        for part in path.split("."):
            c = c.getField(part)
        out.append(c.alias(name))
    return base.select(*out)


def explode_chain(df: DataFrame, steps: Sequence[tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Chained applies. ``steps`` is a list of (column, alias); each step explodes the
    named array column of the previous step's output (struct elements are expanded)."""
    cur = df
    carried = list(keep)
    for col, alias in steps:
        cur = cur.select(*carried, *[c for c in cur.columns if c not in carried and c != col],
                         F.explode(F.col(col)).alias(alias))
        etype = cur.schema[alias].dataType
        if isinstance(etype, T.StructType):
            others = [c for c in cur.columns if c != alias]
            cur = cur.select(*others, *[F.col(alias).getField(f.name).alias(f.name) for f in etype.fields])
    return cur
