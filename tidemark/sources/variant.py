"""Semi-structured records -> named columns.

Schema discovery is a distributed aggregate over *all* records (not one sample
row): the merged schema names the paths, one aggregate counts them, and only the
path catalogue (one row per distinct path) reaches the driver when
:func:`flatten` builds its projection.  Catalogues of landed batches are saved and merged,
so that a growing landing table is never discovered anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import display_path, normalise_name, unique_names, variant_path

KINDS = ("object", "array", "scalar", "null")


def schema_type(schema: str) -> T.DataType:
    """The type that a text of ``schema_of_variant_agg`` names, objects as structs."""
    parts = schema.split("`")  # names with other characters stand in backquotes
    parts[::2] = [p.replace("OBJECT<", "STRUCT<") for p in parts[::2]]
    return T.DataType.fromDDL("`".join(parts))


def top_fields(schema: str | None) -> dict[str, str]:
    """Top-level fields and their types of a text that ``schema_of_variant_agg`` returns; none unless it is an object."""
    if not schema or not schema.startswith("OBJECT<"):
        return {}
    return {f.name: f.dataType.simpleString() for f in schema_type(schema).fields}


_MAP = "map<string,variant>"
_ARR = "array<variant>"


def _entry(steps: Column, x: Column) -> Column:
    """One discovered field: its path, its value, and the value as a map (NULL unless an object)."""
    return F.struct(steps.alias("steps"), x.alias("x"), F.try_variant_get(x, "$", _MAP).alias("m"))


def _children(entries: Column) -> Column:
    """Fields of every object among ``entries`` (array of entries), one level down."""
    objects = F.filter(entries, lambda e: e["m"].isNotNull())
    return F.flatten(
        F.transform(
            objects,
            lambda e: F.transform(
                F.map_entries(e["m"]),
                lambda kv: _entry(F.concat(e["steps"], F.array(kv["key"])), kv["value"]),
            ),
        )
    )


#: More paths than this are counted by the general scan: one expression a path would not fit generated code.
_MOST_EXPRESSIONS = 300


def _tree(dtype: T.DataType, steps: tuple[str, ...], max_depth: int) -> list[tuple[tuple[str, ...], T.DataType]]:
    """(steps, type) of the fields of an object and of the objects in it, down to ``max_depth``."""
    out = []
    for f in dtype.fields:
        path = (*steps, f.name)
        out.append((path, f.dataType))
        if isinstance(f.dataType, T.StructType) and len(path) <= max_depth:
            out += _tree(f.dataType, path, max_depth)
    return out


def _scan_entries(df: DataFrame, entries: Column, max_depth: int, own: bool) -> DataFrame:
    """``steps, kind, n_rows, max_width`` of the fields below ``entries`` (and of the entries themselves, if ``own``).

    Each depth level is a column computed once from the previous one
    (higher-order functions over the record's fields, each value converted to a
    map once), then one explode feeds one aggregate, combined map-side before its shuffle.
    """
    lv = df.select(entries.alias("__l"))
    names = ["__l"] if own else []
    for d in range(max_depth + 1):
        inner = F.filter(F.col("__l" if d == 0 else f"__l{d - 1}"), lambda e: F.size(e["steps"]) <= max_depth)
        lv = lv.select("*", _children(inner).alias(f"__l{d}"))
        names.append(f"__l{d}")
    kv = lv.select(F.explode(F.concat(*[F.col(n) for n in names])).alias("e")).select(
        F.col("e.steps").alias("steps"), F.col("e.x").alias("__v"), F.col("e.m").isNotNull().alias("__obj")
    )
    kv = kv.withColumn("__arr", F.when(~F.col("__obj"), F.size(F.try_variant_get("__v", "$", _ARR))))
    kind = (
        F.when(F.col("__obj"), F.lit("object"))
        .when(F.col("__arr").isNotNull() & (F.col("__arr") >= 0), F.lit("array"))
        .when(F.is_variant_null("__v"), F.lit("null"))
        .otherwise(F.lit("scalar"))
    )
    kv = kv.select("steps", kind.alias("kind"), "__arr")
    return kv.groupBy("steps", "kind").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.when(F.col("kind") == "array", F.col("__arr"))).alias("max_width"),
    )


def discover_paths(df: DataFrame, col: str = "value", max_depth: int = 3, sample: float | None = None) -> DataFrame:
    """Every field path up to ``max_depth`` with its kind.

    Columns: ``steps array<string>``, ``path`` (steps joined by ``.``), ``depth``
    (0 = top level), ``kind``, ``n_rows``, ``max_width`` (largest array size, arrays
    only).  Objects at depth ``< max_depth`` are entered; array elements never are.
    A path seen with several kinds gets one row per kind.  ``sample`` (a fraction)
    restricts discovery to a random sample, as the reference's one-row read did.

    Spark's merged schema of all records names the paths (one aggregate, a job of its own); one more aggregate counts each of
    them by its path expression.  Only below paths of mixed kinds, and for records that are no objects, are the fields listed record by record.
    """
    src = df.sample(fraction=sample, seed=17) if sample else df
    found = src.agg(F.schema_of_variant_agg(col).alias("s")).first()["s"]
    nodes = _tree(schema_type(found), (), max_depth) if found and found.startswith("OBJECT<") else None
    awkward = nodes is None or len(nodes) > _MOST_EXPRESSIONS or any(c in x for steps, _ in nodes for x in steps for c in '"\\')
    if awkward:
        root = F.array(_entry(F.array().cast("array<string>"), F.col(col)))
        agg = _scan_entries(src, root, max_depth, own=False)
    else:
        plain = [(steps, t) for steps, t in nodes if not isinstance(t, T.VariantType)]
        mixed = [steps for steps, t in nodes if isinstance(t, T.VariantType)]
        agg = _count_paths(src, col, plain)
        if mixed:
            literal = lambda steps: F.array(*[F.lit(x) for x in steps])
            entries = F.array(*[_entry(literal(s), F.try_variant_get(col, variant_path(list(s)), "variant")) for s in mixed])
            agg = agg.unionByName(_scan_entries(src, F.filter(entries, lambda e: e["x"].isNotNull()), max_depth, own=True))
    return _presented(agg)


def _count_paths(src: DataFrame, col: str, nodes: list[tuple[tuple[str, ...], T.DataType]]) -> DataFrame:
    """Rows of each path that has one kind (and nulls), from one aggregate."""
    exprs, rows = [], []
    for i, (steps, t) in enumerate(nodes):
        path = variant_path(list(steps))
        v = F.try_variant_get(col, path, "variant")
        kind = "object" if isinstance(t, T.StructType) else "array" if isinstance(t, T.ArrayType) else "null" if isinstance(t, T.NullType) else "scalar"
        is_null = F.coalesce(F.is_variant_null(v), F.lit(False))
        exprs += [F.count(v).alias(f"n{i}"), F.count_if(is_null).alias(f"z{i}")]
        width = F.lit(None).cast("int")
        if kind == "array":
            exprs.append(F.max(F.size(F.try_variant_get(col, path, _ARR))).alias(f"w{i}"))
            width = F.col(f"w{i}")
        name = F.array(*[F.lit(x) for x in steps]).alias("steps")
        n = F.col(f"n{i}") - F.col(f"z{i}") if kind != "null" else F.lit(0).cast("long")
        rows.append(F.struct(name, F.lit(kind).alias("kind"), n.alias("n_rows"), width.alias("max_width")))
        rows.append(F.struct(name, F.lit("null").alias("kind"), F.col(f"z{i}").alias("n_rows"), F.lit(None).cast("int").alias("max_width")))
    if not rows:
        return src.sparkSession.createDataFrame([], "steps array<string>, kind string, n_rows long, max_width int")
    return src.agg(*exprs).select(F.inline(F.array(*rows))).where("n_rows > 0")


def _presented(agg: DataFrame) -> DataFrame:
    return agg.select(
        "steps", F.array_join("steps", ".").alias("path"), (F.size("steps") - 1).alias("depth"),
        "kind", "n_rows", "max_width",
    )


def save_paths(paths: DataFrame, state: str, batch: int | str) -> None:
    """Keep the paths of one landed batch under ``state``; a batch that is repeated replaces its own."""
    paths.select("steps", "kind", "n_rows", "max_width").write.mode("overwrite").parquet(f"{state.rstrip('/')}/batch={batch}")


def saved_paths(spark: SparkSession, state: str) -> DataFrame:
    """The paths of all saved batches together: what :func:`discover_paths` gives for all their rows, without reading them."""
    kept = spark.read.schema("steps array<string>, kind string, n_rows long, max_width int").parquet(state)
    return _presented(kept.groupBy("steps", "kind").agg(F.sum("n_rows").alias("n_rows"), F.max("max_width").alias("max_width")))


def _plan_columns(paths: list, max_depth: int) -> list[tuple[str, str, str]]:
    """(name, json path, output type) per column, in path order, from discovered rows."""
    by_path: dict[tuple, dict] = {}
    for p in paths:
        steps = tuple(p["steps"])
        e = by_path.setdefault(steps, {"kinds": set(), "width": 0, "depth": p["depth"]})
        e["kinds"].add(p["kind"])
        if p["max_width"] is not None:
            e["width"] = max(e["width"], int(p["max_width"]))
    cols = []
    for steps in sorted(by_path):
        e = by_path[steps]
        name = display_path(list(steps))
        jp = variant_path(list(steps))
        kinds = e["kinds"]
        if "object" in kinds or "array" in kinds or kinds == {"null"}:
            cols.append((name, jp, "variant"))
            if "array" in kinds and "object" not in kinds:
                for i in range(e["width"]):
                    cols.append((display_path(list(steps), i), variant_path(list(steps), i), "string"))
        else:
            cols.append((name, jp, "string"))
    return cols


def flatten(
    df: DataFrame,
    paths: DataFrame | list | None = None,
    max_depth: int = 3,
    col: str = "value",
    keep: tuple[str, ...] = ("src_file_nm", "load_ts"),
    max_columns: int | None = 10_000,
) -> DataFrame:
    """Flattened view of landing rows.

    Output: the ``keep`` columns, then per path in path order: scalar -> string
    column; object -> raw variant column (its fields follow while depth allows);
    array -> raw variant column plus one string column per index up to the widest
    array seen; JSON-null-only -> variant column.  Names are normalised (``leg[2]``
    -> ``leg_2``, other characters -> ``_``) and de-duplicated.  Missing paths and
    out-of-range indexes give NULL.  No path at all (an empty landing table) is an error (D21).

    ``max_columns`` bounds the view where records use data as field names: more paths or columns
    than that are an error. None: no bound.
    """
    if paths is None:
        paths = discover_paths(df, col, max_depth)
    if isinstance(paths, DataFrame):
        # at most one row more than the bound reaches the driver
        rows = (paths if max_columns is None else paths.limit(max_columns + 1)).collect()
        if max_columns is not None and len(rows) > max_columns:
            raise ValueError(f"more than max_columns={max_columns} paths; limit the depth or pass the paths")
    else:
        rows = list(paths)
    plan = _view_columns(rows, max_depth)
    if max_columns is not None and len(plan) > max_columns:
        raise ValueError(f"{len(plan)} columns, more than max_columns={max_columns}; limit the depth or pass the paths")
    out = [F.col(k) for k in keep if k in df.columns]
    return df.select(*out, *[F.try_variant_get(F.col(col), path, kind).alias(alias) for alias, path, kind in plan])


def _view_columns(paths: DataFrame | list, max_depth: int) -> list[tuple[str, str, str]]:
    """(column name, json path, type) of a flattened view."""
    rows = paths.collect() if isinstance(paths, DataFrame) else list(paths)
    if not rows:
        raise ValueError("there is nothing to flatten: the landing table holds no path")
    plan = _plan_columns([r.asDict() if hasattr(r, "asDict") else r for r in rows], max_depth)
    names = unique_names([normalise_name(n) for n, _, _ in plan])
    return [(alias, path, kind) for (_, path, kind), alias in zip(plan, names)]


def publish_view(df: DataFrame, name: str, global_view: bool = False) -> DataFrame:
    """Publish ``V_<table>``-style views (U6): a session or global temporary view."""
    if global_view:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createOrReplaceTempView(name)
    return df


def view_sql(table: str, paths: DataFrame | list, max_depth: int = 3, col: str = "value", keep: tuple[str, ...] = ("src_file_nm", "load_ts")) -> str:
    """The ``SELECT`` behind a flattened view of ``table`` (a catalogue name, or ``parquet.`path```)."""
    text = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    name = lambda s: "`" + s.replace("`", "``") + "`"
    columns = [name(k) for k in keep]
    columns += [f"try_variant_get({name(col)}, {text(path)}, '{kind}') AS {name(alias)}" for alias, path, kind in _view_columns(paths, max_depth)]
    return f"SELECT {', '.join(columns)} FROM {table}"


def persist_view(spark: SparkSession, table: str, view: str, paths: DataFrame | list | None = None, max_depth: int = 3, col: str = "value") -> bool:
    """Create or replace the catalogue view ``view`` over a landing table (U6, S11); says whether its text is new.

    The view holds text only, so every session of the catalogue reads it, and later landed rows show in it.  It is replaced in
    one statement, and only when the discovered paths give another text than the one it has.
    """
    if paths is None:
        paths = discover_paths(spark.sql(f"SELECT * FROM {table}"), col, max_depth)
    sql = view_sql(table, paths, max_depth, col)
    if spark.catalog.tableExists(view) and spark.sql(f"SHOW TBLPROPERTIES {view}").where(F.col("key") == "flattened.sql").select("value").collect() == [(sql,)]:
        return False
    quoted = sql.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('flattened.sql' = '{quoted}') AS {sql}")
    return True
