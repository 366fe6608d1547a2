"""Raw event lines and post archives, written as files."""

import json

from tidewatch.schemas import EVENT_SCHEMA


def line(fill="", **fields):
    return "\t".join(str(fields.get(name, fill)) for name in EVENT_SCHEMA.names)


def write_lines(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def write_hits(path, *sources, total=None):
    hits = {"hits": [{"_index": "i", "_id": str(n), "_source": s} for n, s in enumerate(sources)]}
    if total is not None:
        hits["total"] = {"value": total, "relation": "eq"}
    path.write_text(json.dumps({"hits": hits}), encoding="utf-8")
