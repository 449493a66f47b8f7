"""Rules and contracts from files: categories, road classes, crosswalks, groups of features, and their checks before a run."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.status import ATOMIC
from terrace.operators.atomic import FEATURES
from terrace.operators.entities import Rule
from terrace.operators.normalize import METHODS
from terrace.sources.mapfile import open_store

#: Statistics of a neighbourhood.
STATISTICS = ["median", "mean"]
DISTANCES = [f for f in FEATURES if f.startswith("distance_")]
RATIOS = [f for f in FEATURES if f.endswith("_ratio")]


class ConfigError(ValueError):
    """A configuration that contradicts itself or the contract of the features."""


def read(path: str) -> Any:
    """A YAML or JSON file of any store."""
    files, name = open_store(path)
    with files.open_input_file(name) as f:
        text = f.read().decode("utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise ConfigError(f"{path}: reading YAML needs a package that is not here") from e
    return yaml.safe_load(text)


def _clauses(entries: list[dict]) -> list[dict[str, list[str]]]:
    """Clauses as maps of key to values; those that must hold together become one map."""
    out = []
    for entry in entries:
        joined: dict[str, list[str]] = {}
        for part in entry.get("all", [entry]):
            values = [str(v) for v in part["values"]]
            before = joined.get(part["key"])
            joined[part["key"]] = values if before in (None, ["*"]) else before if "*" in values else [v for v in before if v in values]
        out.append(joined)
    return out


def category_rules(taxonomy: dict) -> list[Rule]:
    """The categories in order of precedence; one that excludes others takes their clauses as its exclusions."""
    known = taxonomy["canonical_categories"]
    clauses = {name: _clauses(entry.get("match_any", [])) for name, entry in known.items()}
    order = [name for name in taxonomy["entity_policy"]["category_precedence"] if name in known]
    return [Rule(n, known[n].get("group", ""), clauses[n], [c for other in known[n].get("exclude_if_matches", []) for c in clauses.get(other, [])]) for n in order]


def area_rules(taxonomy: dict) -> list[Rule]:
    return [Rule(name, "area", _clauses(entry.get("match_any", []))) for name, entry in taxonomy.get("area_categories", {}).items()]


def crosswalk(spark: SparkSession, config: dict) -> DataFrame:
    """``source_category, category`` of a mapping that lists source categories by category."""
    return spark.createDataFrame([(own, to) for to, names in config["mapping"].items() for own in names], "source_category string, category string")


def members(groups: dict[str, list[str]], names: Iterable[str]) -> list[str]:
    """Groups and plain names spelled out, each feature once, in order."""
    return list(dict.fromkeys(f for n in names for f in groups.get(n, [n])))


def output_names(config: dict, feature: str) -> dict[str, str]:
    """Names of a feature's derived columns by kind, from the patterns of the configuration; a value's status has its name and a suffix."""
    t = config["transforms"]
    ratio = t["local_ratio"]
    names = {"log1p": t["log1p"]["output_name"], "local_ratio": ratio["output_name"], **{cohort: c["output_name"] for cohort, c in t["percentile"]["cohorts"].items()}}
    return {kind: pattern.format(feature=feature, k=int(ratio["neighborhood"]["k"])) for kind, pattern in names.items()}


def choose_areas(areas: DataFrame, known: list[str], wanted: list[str] | None = None, ident: str = "area") -> DataFrame:
    """Rows of the wanted areas (all known ones, if none are named); an unknown name is an error."""
    if unknown := sorted(set(wanted or []) - set(known)):
        raise ConfigError(f"unknown areas: {', '.join(unknown)}; known: {', '.join(known)}")
    return areas.where(F.col(ident).isin(known if wanted is None else wanted))


def _same(value: Any, wanted: Any) -> bool:
    return value == wanted and isinstance(value, bool) == isinstance(wanted, bool)


def config_problems(config: dict, contract: dict) -> list[str]:
    """Everything in which a configuration of derived features contradicts itself or the contract; empty if nothing.

    A missing entry is a problem like a wrong one.
    """
    features, groups = contract.get("mvp_features", FEATURES), config.get("feature_groups", {})
    out: list[str] = []

    def at(path: str, of: dict = config) -> Any:
        for part in path.split("."):
            of = of.get(part) if isinstance(of, dict) else None
        return of

    def check(path: str, good: Callable[[Any], bool], wanted: str) -> None:
        value = at(path)
        try:
            fine = good(value)
        except (TypeError, ValueError):
            fine = False
        if not fine:
            out.append(f"{path} is {value!r}: {wanted}")

    def listed(path: str, forbidden: list[str], reason: str) -> None:
        found = members(groups, at(path) or [])
        if bad := [f for f in found if f in forbidden or f not in features]:
            out.append(f"{path}: {', '.join(bad)}: {reason}")

    check("input.feature_set_version", lambda v: str(v) == str(contract.get("feature_set_version")), "another version than the contract's")
    if at("contextual_features.enabled", contract):
        out.append("contextual_features.enabled: off in the contract until derived features are accepted")
    for name, own in groups.items():
        if bad := [f for f in own if f not in features]:
            out.append(f"feature_groups.{name}: {', '.join(bad)}: no features of the contract")
    t, pct, ratio = "transforms.log1p", "transforms.percentile", "transforms.local_ratio"
    listed(f"{t}.candidates", RATIOS + DISTANCES, "not for ratios and distances")
    listed(f"{pct}.candidates", DISTANCES, "not for distances, whose search is cut off")
    listed(f"{ratio}.candidates", RATIOS + DISTANCES, "not for ratios and distances")
    for rule, wanted in {"zero_maps_to_zero": True, "null_stays_null": True, "negative_input": "fail", "impute": False, "clip_or_winsorize": False}.items():
        check(f"{t}.rules.{rule}", lambda v, wanted=wanted: _same(v, wanted), f"{wanted!r} by contract")
    check(f"{t}.publish_rule.minimum_raw_skewness", lambda v: float(v) >= 0, "0 or more")
    check(f"{pct}.tie_method", lambda v: v in METHODS, f"one of {', '.join(METHODS)}")
    check(f"{pct}.tie_sensitivity_methods", lambda v: set(v or []) <= set(METHODS), f"some of {', '.join(METHODS)}")
    check(f"{pct}.minimum_cohort_size", lambda v: int(v) >= 2, "2 or more")
    check(f"{pct}.constant_cohort_policy", lambda v: v == "null_with_status", "null with a status")
    check(f"{pct}.range", lambda v: [float(x) for x in v] == [0.0, 1.0], "0 to 1")
    for cohort in at(f"{pct}.cohorts") or {}:
        check(f"{pct}.cohorts.{cohort}.output_name", lambda v: "{feature}" in v and "national_percentile" not in v, "names the feature, and is no national percentile")
    for cohort in ("mvp_pooled_percentile", "within_aoi_percentile"):
        check(f"{pct}.cohorts.{cohort}.disposition", lambda v: v == "diagnostic", "a diagnostic only")
    check(f"{pct}.cohorts.peer_percentile.minimum_aois_per_peer_group", lambda v: int(v) >= 2, "2 or more")
    check(f"{ratio}.neighborhood.k", lambda v: int(v) >= 1, "1 or more")
    check(f"{ratio}.neighborhood.method", lambda v: v == "h3_grid_disk", "rings of cells")
    check(f"{ratio}.neighborhood.exclude_centre", bool, "without the centre")
    check(f"{ratio}.neighborhood.reference_statistic", lambda v: v in STATISTICS, f"one of {', '.join(STATISTICS)}")
    check(f"{ratio}.neighborhood.require_all_neighbors_present", bool, "complete rings only")
    check(f"{ratio}.neighborhood.minimum_valid_neighbors", lambda v: int(v) >= 1, "1 or more")
    check(f"{ratio}.denominator_zero_policy", lambda v: v == "null_with_status", "null with a status, no epsilon")
    check(f"{ratio}.publish_rule.minimum_finite_share_of_eligible", lambda v: 0 < float(v) <= 1, "above 0, 1 at most")
    for flag in ("enabled", "substitute_with_custom_threshold"):
        check(f"transforms.source_defined_ghs_smod_class.{flag}", lambda v: not v, "there is no such source")
    check("status_vocabulary.atomic_passthrough", lambda v: set(ATOMIC) <= set(v), "lacks statuses of the atomic features")
    return out


def check_config(config: dict, contract: dict) -> None:
    if problems := config_problems(config, contract):
        raise ConfigError("; ".join(problems))
