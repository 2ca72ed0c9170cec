"""Feature specs shipped with the package (JSON, read with Spark)."""

import os

SPEC_DIR = os.path.dirname(os.path.abspath(__file__))


def spec_path(name: str) -> str:
    return os.path.join(SPEC_DIR, f"{name}.json")
