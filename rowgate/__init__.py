"""rowgate: data-quality routing, quarantine lifecycle and type-2 history
as DataFrame-to-DataFrame functions on Spark."""

from rowgate.contracts import Params  # noqa: F401

__all__ = ["Params"]
