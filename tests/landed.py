"""Landed batches as another program would leave them."""

import gzip
import hashlib
import json
import os

EXTRACTED = "2025-01-15T10:00:00+00:00"


def land(lake, spec, batch_id, rows=None, files=None, count=None, manifest=True, **extra):
    """JSON-lines rows, or raw files given as {name: bytes} with ``count`` rows."""
    folder = f"{lake.landing}/{spec.source_system}/{spec.dataset}/batch_id={batch_id}"
    os.makedirs(f"{folder}/files")
    listing = []
    if rows is not None:
        path = f"{folder}/files/part-00000.json.gz"
        with gzip.open(path, "wt") as out:
            out.write("".join(json.dumps(r) + "\n" for r in rows))
        listing.append({"name": "part-00000.json.gz", "rows": len(rows), "bytes": os.path.getsize(path), "sha256": _sha(path)})
    for name, content in (files or {}).items():
        with open(f"{folder}/files/{name}", "wb") as out:
            out.write(content)
        listing.append({"name": name, "sha256": _sha(f"{folder}/files/{name}"), "bytes": len(content)})
    os.makedirs(f"{folder}/listing")
    with open(f"{folder}/listing/part-0.json", "w") as out:
        out.write("".join(json.dumps(f) + "\n" for f in listing))
    if manifest:
        body = {
            "batch_id": batch_id, "source_system": spec.source_system, "dataset": spec.dataset,
            "record_count": len(rows or []) if count is None else count, "file_count": len(listing),
            "run_id": f"run-{batch_id}", "extracted_at": EXTRACTED, **extra,
        }
        with open(f"{folder}/manifest.json", "w") as out:
            json.dump(body, out)
    return folder


def _sha(path):
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()
