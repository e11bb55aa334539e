"""Settings that decide results."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class EngineConfig:
    max_listing_urls: int = 40
    max_sitemap_depth: int = 2
    seed_expansion_depth: int = 2
    max_hub_pages: int = 6
    max_franchise_hosts: int = 8
    max_rendered_details: int = 3
    max_html_chars: int = 3_000_000
    renderer_available: bool = False
    geocoding: bool = True
    limit: int | None = None
    keep_outputs: bool = False
    reset_checkpoint: bool = False
    listings_name: str = "listings_consolidated"
    error_log_name: str = "error_log"
    domain_summary_name: str = "domain_status_summary"
    report_name: str = "report"
    max_files_per_trigger: int = 1
    #: Seconds that a domain's work may take, and the share of them that must be left to begin with rendered pages.
    domain_time_budget: float = 120.0
    fallback_share: float = 0.2

    @classmethod
    def from_environment(cls, prefix: str = "GLEANER_", environment: Mapping[str, str] | None = None) -> EngineConfig:
        """Settings as variables in capitals give them: numbers, and 1, true, yes or on for what can be on. An empty ``limit`` is none."""
        given = os.environ if environment is None else environment
        made = {}
        for f in fields(cls):
            text = given.get(prefix + f.name.upper())
            if text is None:
                continue
            kind = str(f.type)
            if kind == "bool":
                made[f.name] = text.strip().lower() in ("1", "true", "yes", "on")
            elif kind.startswith("int"):
                made[f.name] = int(text) if text.strip() or "None" not in kind else None
            else:
                made[f.name] = float(text) if kind == "float" else text
        return replace(cls(), **made)
