"""Row-level scoping: which applications a viewer may see, decided before any aggregate.

entitlements: identity_provider, principal_id, environment, role, scope_type, scope_id,
is_active, valid_from, valid_to. scopes: environment, application_code, domain_id,
subdomain_id, is_active.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Tables

# The scope type of each role.
ROLES = {"FINOPS_ADMIN": "ALL", "APPLICATION_OWNER": "APPLICATION", "DOMAIN_MANAGER": "DOMAIN", "SUBDOMAIN_MANAGER": "SUBDOMAIN"}


def live(now: Column) -> Column:
    """Active and within validity; a null bound is open."""
    return F.col("is_active") & (F.col("valid_from").isNull() | (F.col("valid_from") <= now)) & (F.col("valid_to").isNull() | (now < F.col("valid_to")))


def entitlements_of(entitlements: DataFrame, provider: str, principal: str, environment: str, now: Column) -> DataFrame:
    mine = (F.col("identity_provider") == provider) & (F.col("principal_id") == principal) & (F.col("environment") == environment)
    return entitlements.where(mine & live(now)).select("role", "scope_type", "scope_id")


def invalid_entitlements(mine: DataFrame, *by: str) -> DataFrame:
    """Rows that make access refused: wrong scope type, blank, padded or unknown scope, a star outside the admin role, duplicates.

    mine holds one viewer's rows, or several viewers' told apart by the columns named.
    """
    scope = F.coalesce(F.col("scope_id"), F.lit(""))
    matches = F.lit(False)
    for role, kind in ROLES.items():
        matches |= (F.col("role") == role) & (F.col("scope_type") == kind)
    finding = (
        F.when(~F.coalesce(matches, F.lit(False)), "role and scope type")
        .when((F.trim(scope) == "") | (scope != F.trim(scope)) | (F.lower(scope) == "unknown"), "scope")
        .when((F.col("role") == "FINOPS_ADMIN") != (scope == "*"), "star")
        .when(F.col("copies") > 1, "duplicate")
    )
    counted = mine.groupBy(*by, "role", "scope_type", "scope_id").agg(F.count("*").alias("copies"))
    return counted.withColumn("finding", finding).where("finding is not null")


def clear_scopes(scopes: DataFrame, environment: str) -> DataFrame:
    """Applications of the environment with exactly one active mapping."""
    named = F.lower(F.trim("application_code"))
    valid = scopes.where((F.col("environment") == environment) & F.col("is_active") & F.col("application_code").isNotNull() & ~named.isin("", "unknown"))
    return valid.groupBy("application_code").agg(F.count("*").alias("_n"), F.max("domain_id").alias("domain_id"), F.max("subdomain_id").alias("subdomain_id")).where("_n = 1").drop("_n")


def ambiguous_scopes(scopes: DataFrame, environment: str) -> DataFrame:
    valid = scopes.where((F.col("environment") == environment) & F.col("is_active") & F.col("application_code").isNotNull())
    return valid.groupBy("application_code").agg(F.count("*").alias("mappings")).where("mappings > 1")


def visible_applications(mine: DataFrame, scopes: DataFrame, environment: str) -> DataFrame:
    """Distinct applications of the viewer: each role is an equality, so each is a hash semi join."""
    clear = clear_scopes(scopes, environment)

    def by(role: str, column: str) -> DataFrame:
        granted = mine.where((F.col("role") == role) & (F.col("scope_type") == ROLES[role])).select(F.col("scope_id").alias(column))
        return clear.join(granted, column, "left_semi").select("application_code")

    found = by("APPLICATION_OWNER", "application_code").union(by("DOMAIN_MANAGER", "domain_id")).union(by("SUBDOMAIN_MANAGER", "subdomain_id"))
    return found.distinct()


def _admin(mine: DataFrame) -> DataFrame:
    """One row if the viewer is an admin, else none."""
    return mine.where("role = 'FINOPS_ADMIN' and scope_id = '*'").limit(1).select(F.lit(True).alias("_admin"))


def for_admins(rows: DataFrame, mine: DataFrame) -> DataFrame:
    """rows for an admin, none for anybody else: for what no scope restricts, such as run logs and usage telemetry."""
    return rows.join(F.broadcast(_admin(mine)), F.lit(True), "left_semi")  # one flag


def scoped(rows: DataFrame, mine: DataFrame, scopes: DataFrame, environment: str) -> DataFrame:
    """Rows that the viewer may see, each once. An admin sees the environment, also rows without an application."""
    own = rows.where(F.col("environment") == environment)
    admin = _admin(mine)
    marked = own.join(F.broadcast(admin), F.lit(True), "left")  # one flag
    apps = visible_applications(mine, scopes, environment).withColumn("_visible", F.lit(True))
    return marked.join(apps, "application_code", "left").where("_admin or _visible").select(*rows.columns)


#: Parts of a stored serving table, by a hash of the application.
APPLICATION_PARTS, PART = 64, "application_part"


def application_part(c: str = "application_code") -> Column:
    """The part of an application's rows; rows without one are in a part of their own, which no viewer's applications name."""
    return F.when(F.col(c).isNull(), -1).otherwise(F.pmod(F.xxhash64(c), F.lit(APPLICATION_PARTS))).cast("int")


def store(tables: Tables, rows: DataFrame, name: str) -> int:
    """Serving rows, whose application was taken from the tags before, dealt to parts by application."""
    return tables.append(rows.withColumn(PART, application_part()), name, (PART,))


def scoped_stored(tables: Tables, name: str, mine: DataFrame, scopes: DataFrame, environment: str) -> DataFrame:
    """scoped() of a table that store() wrote: only the parts of the viewer's applications are read, and no tags."""
    rows = tables.read(name)
    if not _admin(mine).isEmpty():
        return rows.where(F.col("environment") == environment).drop(PART)
    apps = visible_applications(mine, scopes, environment)
    parts = [r[0] for r in apps.select(application_part()).distinct().collect()]  # APPLICATION_PARTS at most
    return rows.where(F.col(PART).isin(parts) & (F.col("environment") == environment)).join(apps, "application_code", "left_semi").select(*(c for c in rows.columns if c != PART))


def assignment_matches(expected: DataFrame, entitlements: DataFrame, now: Column) -> DataFrame:
    """For each expected grant how many live ones there are; exactly one is right."""
    keys = ["identity_provider", "principal_id", "environment", "role", "scope_type", "scope_id"]
    found = entitlements.where(live(now)).groupBy(*keys).agg(F.count("*").alias("matches"))
    return expected.join(found, keys, "left").select(*keys, F.coalesce("matches", F.lit(0)).alias("matches"))
