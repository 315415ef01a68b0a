"""A PySpark engine for a catalogue of software-tool metadata. The names in ``__all__`` are the public interface, loaded when asked for; the training-data operators are in toolgraph.llm."""

from importlib import import_module

__version__ = "0.2.0"

_WHERE = {
    "credits": "functions.authors", "normalise_licenses": "functions.licenses:normalise", "convert": "operators.converter", "create": "operators.converter", "sync": "operators.converter",
    "tool_id": "operators.converter", "update": "operators.converter", "IDENTITIES": "operators.matching", "assign": "operators.matching", "keys": "operators.matching", "matched": "operators.matching",
    "register_identity": "operators.matching", "unmatched": "operators.matching",
}
__all__ = sorted(_WHERE)


def __getattr__(name: str):
    if name not in _WHERE:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    module, _, other = _WHERE[name].partition(":")
    return getattr(import_module(f".{module}", __name__), other or name)
