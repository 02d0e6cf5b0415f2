"""Table shapes of the entity-resolution engine."""

from pyspark.sql import types as T

_s = lambda *names: T.StructType([T.StructField(n, T.StringType()) for n in names])

ENTITY = _s("entity_id", "business_name", "business_address", "country")
TRUTH = _s("source1_entity_id", "matched_entity_ids")
LINKS = _s("s1_id", "cand_id")
SOURCES = ("S1", "S2", "S3")


class DataValidationError(ValueError):
    """A table breaks its contract."""


class SchemaMismatchError(DataValidationError):
    """A required column is missing."""


class DuplicateIdError(DataValidationError):
    """An id that must be unique is not."""


class InvalidIdPrefixError(DataValidationError):
    """An id doesn't start with its source's prefix."""
