"""Column roles and the source/target reconciliation (U27) with its checks (2.12).

Roles are named once, as a dataclass; reconciliation works on ``df.schema`` on the
driver, which replaces the catalogue query.  Only metadata crosses to the driver.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Column names that take the SYS role by name (must equal the reference's).
SYS_BY_NAME = ("ICW_EFF_TS", "ICW_EXP_TS")
ROLE_NAMES = ("KEY", "KEM", "HIS", "BUS", "SYS", "OPR")


class RoleError(ValueError):
    """Roles and schemas do not fit together."""


@dataclass(frozen=True)
class Roles:
    """Column roles of a merge or key generation.

    ``key``: identity columns (KEY); ``kem``: the master part of the key (KEM),
    listed in ``key`` or not; ``his``: tracked attributes, ``None`` means every
    target column not given another role; ``bus``: business period ``(start, end)``;
    ``sys``: system period ``(start, end)``, or the surrogate column for key
    generation; ``opr``: logical-delete flag column in the source.
    """

    key: tuple[str, ...] = ()
    kem: tuple[str, ...] = ()
    his: tuple[str, ...] | None = None
    bus: tuple[str, ...] = ()
    sys: tuple[str, ...] = ()
    opr: str | None = None

    @classmethod
    def parse(cls, text: str) -> "Roles":
        """``'KEY:[k1,k2]; BUS:[s,e]; OPR:op'`` -> :class:`Roles` (case kept)."""
        found: dict[str, list[str]] = {}
        for part in (text or "").split(";"):
            if not part.strip():
                continue
            if ":" not in part:
                raise RoleError(f"role entry without ':' - {part.strip()}")
            name, cols = part.split(":", 1)
            name = name.strip().upper()
            if name == "UPD":
                raise RoleError("UPD is not a role here: every changed column is tracked through HIS")
            if name not in ROLE_NAMES:
                raise RoleError(f"{name} is none of the roles {', '.join(ROLE_NAMES)}")
            toks = [t.strip() for t in cols.replace("[", " ").replace("]", " ").replace(",", " ").split()]
            found.setdefault(name, []).extend(t for t in toks if t)
        opr = found.get("OPR", [])
        if len(opr) > 1:
            raise RoleError(f"one delete flag (OPR) at most, not {len(opr)}")
        kem = tuple(found.get("KEM", []))
        return cls(
            key=tuple(kem) + tuple(c for c in found.get("KEY", []) if c not in kem),
            kem=kem,
            his=tuple(found["HIS"]) if "HIS" in found else None,
            bus=tuple(found.get("BUS", [])),
            sys=tuple(found.get("SYS", [])),
            opr=opr[0] if opr else None,
        )


@dataclass(frozen=True)
class Resolved:
    """Roles checked against the schemas, with target-cased names and types."""

    key: list[str]
    kem: list[str]
    his: list[str]
    bus: list[str]
    sys: list[str]
    opr: str | None
    types: dict[str, T.DataType]
    other: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)


def _index(schema: T.StructType) -> dict[str, T.StructField]:
    return {f.name.upper(): f for f in schema.fields}


def resolve_roles(src: T.StructType, tgt: T.StructType, roles: Roles, kind: str) -> Resolved:
    """Reconcile source and target columns with the roles.

    ``kind`` is ``'scd2'``, ``'temporal'`` or ``'keygen'``.  Raises :class:`RoleError`
    on the rule violations of the reference; source-only columns are warned about
    and left out (the OPR column is exempt).
    """
    s_idx, t_idx = _index(src), _index(tgt)
    if not s_idx or not t_idx:
        raise RoleError("source and target must both have columns")

    def tname(c: str, where: dict[str, T.StructField], label: str) -> str:
        f = where.get(c.upper())
        if f is None:
            raise RoleError(f"the {label} has no column {c}, which a role names")
        return f.name

    warnings: list[str] = []
    types = {f.name: f.dataType for f in tgt.fields}

    if kind == "keygen":
        key = [tname(c, s_idx, "source") for c in roles.key]
        if not key:
            raise RoleError("no key column is given")
        if len(roles.sys) != 1:
            raise RoleError(f"exactly one surrogate (SYS) column is needed, not {len(roles.sys)}")
        sys_col = roles.sys[0]
        for f in src.fields:  # what is loaded must have a place; a target column without a source stays empty
            if f.name.upper() not in t_idx and f.name.upper() != sys_col.upper():
                raise RoleError(f"the target has no column for the source column {f.name}")
        for f in tgt.fields:
            if f.name.upper() not in s_idx and f.name.upper() != sys_col.upper():
                warnings.append(f"target column {f.name} is not filled: the source has no such column")
                log.warning(warnings[-1])
        types = {f.name: f.dataType for f in src.fields}
        other = [f.name for f in src.fields if f.name.upper() not in {k.upper() for k in key} | {sys_col.upper()}]
        if sys_col.upper() in s_idx:
            sys_col = s_idx[sys_col.upper()].name
        return Resolved(key, [], [], [], [sys_col], None, types, other, warnings)

    key = [tname(c, t_idx, "target") for c in roles.key]
    kem = [tname(c, t_idx, "target") for c in roles.kem]
    key = kem + [k for k in key if k not in kem]
    bus = [tname(c, t_idx, "target") for c in roles.bus]
    sys_ = [tname(c, t_idx, "target") for c in roles.sys] or [
        t_idx[n].name for n in SYS_BY_NAME if n in t_idx
    ]
    opr = None
    if roles.opr:
        f = s_idx.get(roles.opr.upper())
        if f is None:
            raise RoleError(f"the source lacks the delete flag {roles.opr}")
        opr = f.name

    if not key:
        raise RoleError("no key column is given")
    if kind == "temporal" and len(bus) != 2:
        raise RoleError("a business period takes two BUS columns")
    if kind == "scd2" and bus:
        raise RoleError("a type-2 merge has no business period; temporal_merge takes BUS columns")
    if len(sys_) != 2:
        raise RoleError("a system period takes two SYS columns")

    taken = {c.upper() for c in key + bus + sys_}
    if roles.his is None:
        his = [f.name for f in tgt.fields if f.name.upper() not in taken]
    else:
        his = [tname(c, t_idx, "target") for c in roles.his]
        # a target column without a role is tracked like the named ones; it is never blanked
        named = taken | {c.upper() for c in his}
        his += [f.name for f in tgt.fields if f.name.upper() not in named]
    if not his:
        raise RoleError("a merge needs a tracked (HIS) column")

    for f in tgt.fields:
        if f.name.upper() in {c.upper() for c in sys_}:
            continue
        if f.name.upper() in {c.upper() for c in key + bus + his} and f.name.upper() not in s_idx:
            raise RoleError(f"the source lacks the target column {f.name}")
    for f in src.fields:
        if f.name.upper() not in t_idx and (opr is None or f.name.upper() != opr.upper()):
            msg = f"source column {f.name} is left out: the target has no such column"
            warnings.append(msg)
            log.warning(msg)
    return Resolved(key, [k for k in kem], his, bus, sys_, opr, types, [], warnings)


def schema_diff(src: DataFrame, tgt: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Full outer join of the two column lists with the role each column takes.

    Columns: ``column_name, src_position, tgt_position, src_type, tgt_type, role,
    status`` where status is ``both``, ``source_only`` or ``target_only``.
    """
    spark = SparkSession.getActiveSession() or src.sparkSession
    given: dict[str, str] = {}
    if roles is not None:
        for name, cols in (("KEY", roles.key), ("KEM", roles.kem), ("HIS", roles.his or ()),
                           ("BUS", roles.bus), ("SYS", roles.sys), ("OPR", (roles.opr,) if roles.opr else ())):
            for c in cols:
                given[c.upper()] = name
    schema = "column_name string, position int, data_type string"
    s = spark.createDataFrame(
        [(f.name, i + 1, f.dataType.simpleString()) for i, f in enumerate(src.schema.fields)], schema
    )
    t = spark.createDataFrame(
        [(f.name, i + 1, f.dataType.simpleString()) for i, f in enumerate(tgt.schema.fields)], schema
    )
    s = s.select(F.upper("column_name").alias("u"), F.col("column_name").alias("s_name"),
                 F.col("position").alias("src_position"), F.col("data_type").alias("src_type"))
    t = t.select(F.upper("column_name").alias("u"), F.col("column_name").alias("t_name"),
                 F.col("position").alias("tgt_position"), F.col("data_type").alias("tgt_type"))
    role_map = F.create_map(*[x for k, v in given.items() for x in (F.lit(k), F.lit(v))]) if given else None
    j = s.join(t, "u", "full_outer")
    given_role = role_map[F.col("u")] if role_map is not None else F.lit(None).cast("string")
    role = (
        F.when(given_role.isNotNull(), given_role)
        .when(F.col("u").isin(*SYS_BY_NAME), F.lit("SYS"))
        .otherwise(F.lit("HIS"))
    )
    status = (
        F.when(F.col("s_name").isNotNull() & F.col("t_name").isNotNull(), F.lit("both"))
        .when(F.col("t_name").isNull(), F.lit("source_only"))
        .otherwise(F.lit("target_only"))
    )
    return j.select(
        F.coalesce("t_name", "s_name").alias("column_name"),
        "src_position", "tgt_position", "src_type", "tgt_type",
        role.alias("role"), status.alias("status"),
    )


def schema_diff_tables(spark: SparkSession, source: str, target: str, roles: Roles | None = None) -> DataFrame:
    """:func:`schema_diff` of two catalogue tables or views, by name.

    Only the table schemas are read (``spark.table(...).schema`` resolves through
    the session catalogue); no data is scanned.
    """
    return schema_diff(spark.table(source), spark.table(target), roles)
