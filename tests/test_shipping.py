"""Functions for Python workers must load where this package is not installed."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle

from medallion.operators.knn import _nearest
from medallion.sources.files import _heads
from queries.registry import offline_writer

LOAD = "import pickle, sys; f = pickle.load(sys.stdin.buffer); assert callable(f); print('medallion' in sys.modules)"


@pytest.mark.parametrize("function", [_nearest, _heads, offline_writer])
def test_function_loads_without_the_package(function, tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", LOAD], input=cloudpickle.dumps(function), capture_output=True, cwd=tmp_path, check=True
    )
    assert done.stdout.strip() == b"False"
