"""Storage URIs: parsing, resolving to roles, failures as rows."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.text import is_blank

#: What each category of failure means; the last two are of stored objects.
DETAILS = {
    "missing_uri": "there is no URI", "unsupported_scheme": "the URI isn't a storage URI", "malformed_uri": "the URI lacks a profile, a namespace or a key", "unsafe_key": "the key leaves its namespace",
    "unknown_namespace": "no role has this namespace", "profile_mismatch": "the namespace belongs to another profile", "artifact_unavailable": "the object can't be read", "evidence_refs_missing": "the manifest lists no evidence",
}
_PATTERN = r"^storage://([^/]+)/([^/]+)/(.+)$"


def parts(uri: Column) -> Column:
    """(profile, namespace, key), fields null where the URI has another form."""
    piece = lambda k: F.nullif(F.regexp_extract(uri, _PATTERN, k), F.lit(""))
    return F.struct(piece(1).alias("profile"), piece(2).alias("namespace"), piece(3).alias("key"))


def resolved(uris: DataFrame, roles: DataFrame) -> DataFrame:
    """URIs joined to ``roles`` (namespace, role, role_profile); ``failure`` names what is wrong."""
    own = uris.withColumn("p", parts(F.col("uri"))).select("*", "p.*").drop("p")
    met = own.join(roles, "namespace", "left")
    failure = (
        F.when(is_blank(F.col("uri")), "missing_uri")
        .when(~F.startswith("uri", F.lit("storage://")), "unsupported_scheme")
        .when(F.col("key").isNull(), "malformed_uri")
        .when(F.col("key").rlike(r"(^|/)\.\.(/|$)"), "unsafe_key")
        .when(F.col("role").isNull(), "unknown_namespace")
        .when(F.col("role_profile") != F.col("profile"), "profile_mismatch")
    )
    return met.withColumn("failure", failure)


class Storage:
    """Places of storage URIs: ``roles`` maps a namespace to (role, profile, root folder)."""

    def __init__(self, roles: Mapping[str, tuple[str, str, str]]) -> None:
        self.roles = dict(roles)

    def table(self, spark: SparkSession) -> DataFrame:
        """The roles as rows, for ``resolved``."""
        return spark.createDataFrame([(n, r, p) for n, (r, p, _) in self.roles.items()], "namespace string, role string, role_profile string")

    def uri(self, namespace: str, key: str) -> str:
        return f"storage://{self.roles[namespace][1]}/{namespace}/{key}"

    def locate(self, uri: str) -> str:
        """The path of one URI; a path of another kind is its own place. Errors as in ``resolved``."""
        if not uri.startswith("storage://"):
            return uri
        found = re.match(_PATTERN, uri)
        if not found:
            raise ValueError(f"malformed_uri: {uri}")
        profile, namespace, key = found.groups()
        if ".." in key.split("/"):
            raise ValueError(f"unsafe_key: {uri}")
        if namespace not in self.roles:
            raise ValueError(f"unknown_namespace: {uri}")
        if self.roles[namespace][1] != profile:
            raise ValueError(f"profile_mismatch: {uri}")
        return f"{self.roles[namespace][2].rstrip('/')}/{key}"


def failures(resolved_uris: DataFrame) -> DataFrame:
    """Uniform failure rows: what was asked for, what was found, the category and a sentence."""
    said = F.create_map(*[F.lit(x) for kv in DETAILS.items() for x in kv])
    return resolved_uris.where("failure is not null").select("uri", "namespace", "role", "profile", F.col("failure").alias("category"), F.try_element_at(said, F.col("failure")).alias("detail"))
