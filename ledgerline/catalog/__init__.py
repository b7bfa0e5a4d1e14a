"""Queries over the driver tables, with the SQL each is compared against."""

from importlib import import_module

SECTIONS = [
    "sources", "relational", "aggregates", "scalars", "quality", "streams", "activity", "features", "web", "surveys", "licenses",
    "revenue", "crm", "release",
]



def load() -> None:
    for name in SECTIONS:
        import_module(f"{__name__}.{name}")
