"""The entry point beside the corpus operators."""

import os
import subprocess
import sys

import __spark_entry__ as entry


def test_a_missing_library_is_an_error(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = "import sys; sys.modules['xxhash'] = None\ntry:\n    import __spark_entry__\nexcept ImportError as e:\n    assert e.name == 'xxhash'\nelse:\n    raise SystemExit(1)"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
