"""Records as items of YAML lists, in the form in which published directories store them."""

from __future__ import annotations

import re
from functools import lru_cache


@lru_cache(1)
def _dumper() -> type:
    import yaml

    class Dumper(getattr(yaml, "CSafeDumper", yaml.SafeDumper)):
        """Block style, lines folded at 80 columns, double quotes where a plain text could be read as something else by YAML 1.1."""

    def text(d: Dumper, s: str) -> yaml.ScalarNode:
        doubtful = s in ("y", "Y", "n", "N") or re.search(r"(?m)^\W[^\"]*$", s)
        return d.represent_scalar("tag:yaml.org,2002:str", s, style='"' if doubtful else "|" if re.search(r"\n(?!\Z)", s) else None)

    Dumper.add_representer(str, text)
    return Dumper


def _whole(record):
    """Without null fields, at any depth."""
    if isinstance(record, dict):
        return {k: _whole(v) for k, v in record.items() if v is not None}
    return [_whole(x) for x in record] if isinstance(record, list) else record


def yaml_item(record: dict) -> str:
    import yaml

    return yaml.dump([_whole(record)], Dumper=_dumper(), sort_keys=False, allow_unicode=True, default_flow_style=False)
