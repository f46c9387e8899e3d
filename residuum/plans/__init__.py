"""Named query plans."""

from importlib import import_module


def load():
    """The catalogue with every query module imported."""
    for name in ("flagship", "evidence", "relational", "structural", "textual", "temporal", "spatial", "fusing", "regions", "annotation", "textual_sources", "slots", "codecs"):
        import_module(f"{__name__}.{name}")
    return import_module(f"{__name__}.catalog")
