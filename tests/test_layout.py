"""The training-data subpackage can be deleted: nothing else in the library imports it."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_nothing_else_imports_the_training_data_operators():
    for path in (ROOT / "gridops").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"import.*\bllm\b|from .*\bllm\b", path.read_text()), path
