from oreflow.plans.flows import BronzeFlow, SilverFlow, bronze, ingest, silver, silver_changes
from oreflow.plans.monitor import Thresholds

__all__ = ["BronzeFlow", "SilverFlow", "Thresholds", "bronze", "ingest", "silver", "silver_changes"]
