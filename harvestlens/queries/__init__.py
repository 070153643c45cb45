"""Registered queries over the trade tables, each with its SQL twin where SQL can say it."""

from harvestlens.queries import (
    cleaning, explorer, features, filters, forecast, models, overview, sources, star, stored, streaming,
)

MODULES = [sources, cleaning, star, filters, overview, explorer, features, models, forecast, stored, streaming]
