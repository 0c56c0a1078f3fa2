"""Row-level security: permission lookup, cube rules, grouped clauses."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.functions.times import between
from parcelmill.plans import semantic

ADMIN, MANAGER, DRIVER, GUEST = "ADMIN", "REGIONAL_MANAGER", "DRIVER", "GUEST"
ALL = "ALL"


@dataclass(frozen=True)
class Access:
    username: str
    role: str = GUEST
    provinces: tuple[str, ...] = ()

    @property
    def unrestricted(self) -> bool:
        return self.role == ADMIN or ALL in self.provinces


def permission_row(permissions: DataFrame, username: str) -> DataFrame:
    """Role and provinces of a user, as a filter on the permission table; unknown users have no row.

    Of several rows the one that was updated last counts; among equal times the first by role and areas.
    """
    stamp = [F.col("updated_at").desc_nulls_last()] if "updated_at" in permissions.columns else []
    own = permissions.filter(F.col("username") == F.lit(username))
    return own.orderBy(*stamp, F.col("role").asc_nulls_last(), F.col("province_access").asc_nulls_last()).limit(1)


def lookup(permissions: DataFrame, username: str) -> Access:
    """Access of a user. An unknown user is a guest without provinces."""
    row = permission_row(permissions, username).first()
    if row is None:
        return Access(username)
    return Access(username, row["role"] or "USER", tuple(row["province_access"] or ()))


def row_filter(access: Access, cube: semantic.Cube) -> Column | None:
    """Predicate on the cube's base rows, or None for unrestricted access.

    Anything that is not explicitly allowed sees no rows. A driver is refused the booking cube.
    """
    if access.unrestricted:
        return None
    if access.role == DRIVER and cube.name == semantic.SHIPMENTS.name:
        raise PermissionError(f"{access.username}: drivers have no access to {cube.name}")
    if access.role not in (MANAGER, DRIVER) or not access.provinces:
        return F.lit(False)
    return semantic.dimension(cube, cube.province).isin(list(access.provinces))


def secure(base: DataFrame, access: Access, cube: semantic.Cube) -> DataFrame:
    """Base rows the user may see; the filter sits below every user predicate."""
    predicate = row_filter(access, cube)
    return base if predicate is None else base.filter(predicate)


def secure_by_table(base: DataFrame, permissions: DataFrame, username: str, cube: semantic.Cube) -> DataFrame:
    """The rules of ``secure`` for a user with any number of areas, which stay in the permission table.

    Only the user's role, and whether everything is granted, come to the driver; a restricted user's rows are
    found by a semi join with the listed areas.
    """
    row = permission_row(permissions, username)
    everything = F.coalesce(F.array_contains("province_access", ALL), F.lit(False))
    found = row.select("role", everything.alias("everything")).first()
    access = Access(username, *(() if found is None else (found["role"] or "USER", (ALL,) if found["everything"] else ())))
    if access.unrestricted:
        return base
    if access.role == DRIVER and cube.name == semantic.SHIPMENTS.name:
        raise PermissionError(f"{username}: drivers have no access to {cube.name}")
    if access.role not in (MANAGER, DRIVER):
        return base.filter(F.lit(False))
    areas = row.select(F.explode("province_access").alias("_area")).distinct()
    return base.join(areas, semantic.dimension(cube, cube.province) == F.col("_area"), "left_semi")


def secured_query(
    bases: dict[str, DataFrame],
    permissions: DataFrame,
    username: str,
    measures: list[str],
    dimensions: list[str] | None = None,
    filters: dict[str, list] | None = None,
    time_range: tuple[str, str] | None = None,
    order: list[tuple[str, bool]] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Semantic query as ``username``, with members named ``Cube.member``.

    ``filters`` gives the allowed values of dimensions, ``time_range`` the days from the first to before the
    second; ``order`` holds members with True for ascending. All of them apply to rows that the user may see.
    """
    filters = filters or {}
    members = [*measures, *(dimensions or []), *filters]
    cube = semantic.cube_of(members)
    rows = secure(bases[cube.name], lookup(permissions, username), cube)
    for name, values in filters.items():
        rows = rows.filter(semantic.dimension(cube, name.split(".", 1)[1]).isin(list(values)))
    if time_range is not None:
        day = F.col(cube.dimensions[cube.time])
        rows = rows.filter(between(day, *[F.lit(t).cast("date") for t in time_range]))

    def short(names: list[str]) -> list[str]:
        return [n.split(".", 1)[1] for n in names]

    result = semantic.query(rows, cube, short(measures), short(dimensions or []))
    if order:
        by = zip(short([member for member, _ in order]), (ascending for _, ascending in order))
        result = result.orderBy(*[F.col(n).asc() if ascending else F.col(n).desc() for n, ascending in by])
    return result if limit is None else result.limit(limit)


@dataclass(frozen=True)
class Clause:
    predicate: str
    group: str | None = None


@dataclass(frozen=True)
class ClauseRules:
    """SQL predicates of one dataset: clauses of one group are alternatives, the rest must all hold."""

    clauses: list[Clause] = field(default_factory=list)

    def condition(self) -> Column:
        groups: dict[str, list[Column]] = {}
        parts = []
        for clause in self.clauses:
            if clause.group is None:
                parts.append(F.expr(clause.predicate))
            else:
                groups.setdefault(clause.group, []).append(F.expr(clause.predicate))
        parts += [reduce(lambda a, b: a | b, g) for g in groups.values()]
        return reduce(lambda a, b: a & b, parts, F.lit(True))

    def apply(self, df: DataFrame) -> DataFrame:
        return df.filter(self.condition())
