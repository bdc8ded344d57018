"""Data Vault quality checks as Spark jobs."""

from vaultgauge.plans.passes import checks_of
from vaultgauge.plans.runner import Report, validate
from vaultgauge.settings import Settings
from vaultgauge.sources.vault import Vault

__all__ = ["Report", "Settings", "Vault", "checks_of", "validate"]
