"""campaignlake: ad-event layers (raw -> typed -> campaign metrics) on Spark."""

from campaignlake.session import build_session, pin_session

__all__ = ["build_session", "pin_session"]
__version__ = "0.1.0"
