"""Hand-made page documents for tests."""

import json
import os


def write_pages(root: str, name: str, pages: list[dict]) -> str:
    """Write hand-made page documents as one JSON-lines file."""
    path = f"{root}/{name}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/pages.json", "w") as f:
        for p in pages:
            f.write(json.dumps(p) + "\n")
    return path
