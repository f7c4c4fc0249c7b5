"""Named queries over the star-schema tables, each beside the SQL that must give the same rows."""

from tapewatch.plans.catalog import models, runs, scalars, sources, streams, summaries, windows  # noqa: F401
from tapewatch.plans.catalog.base import ORACLES, QUERIES  # noqa: F401
