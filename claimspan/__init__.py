"""Insurance-claims analytics on Spark DataFrames."""

from claimspan.model import ClaimsModel, filter_model

__all__ = ["ClaimsModel", "filter_model"]
