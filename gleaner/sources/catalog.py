"""Catalog file to a catalog DataFrame. The file is configuration, not data."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..operators.catalog import enabled_sources, with_defaults
from ..params import FilterParams
from ..schema import CATALOG

_FIELDS = ("name", "rss_url", "base_url", "blog_path", "default_tags", "js_rendered", "enabled", "priority")


def load_config(path: str) -> dict:
    """Parse a YAML or JSON file with rss_sources, html_sources, filtering, global."""
    raw = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(raw)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs PyYAML; use a .json file instead") from e
    return yaml.safe_load(raw)


def catalog_frame(spark: SparkSession, config: dict) -> DataFrame:
    """Enabled sources of a parsed configuration, feeds and pages together."""
    rows = [
        (source_id, method, *(entry.get(f) for f in _FIELDS))
        for section, method in (("rss_sources", "rss"), ("html_sources", "html"))
        for source_id, entry in (config.get(section) or {}).items()
    ]
    columns = "source_id STRING, method STRING, " + CATALOG.split("method STRING,")[1]
    return enabled_sources(with_defaults(spark.createDataFrame(rows, columns)))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return catalog_frame(spark, load_config(path))


def filter_params(config: dict, lookback_days: int | None = None) -> FilterParams:
    """Filter settings of a configuration; ``lookback_days`` 0 switches the date test off."""
    section = config.get("filtering") or {}
    days = lookback_days
    if days is None:
        days = (config.get("global") or {}).get("lookback_days", FilterParams.lookback_days)
    return FilterParams(
        lookback_days=days,
        min_words=section.get("min_word_count", 0),
        max_words=section.get("max_word_count"),
        keywords=tuple(section.get("relevant_keywords") or ()),
        exclude_patterns=tuple(section.get("exclude_patterns") or ()),
    )
