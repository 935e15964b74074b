"""Every view by name, and the heavy ones worth writing once per load."""

from __future__ import annotations

from regiostat.plans import credit, economy, institutions

VIEWS = {**credit.VIEWS, **institutions.VIEWS, **economy.VIEWS}

# Heavy views in dependency order.
MATERIALISED = [
    "place_credit", "place_credit_per_capita", "credit_penetration", "sector_jobs",
    "place_employment", "place_companies", "sector_crosswalk", "state_scorecard", "place_ranking",
]
