"""Functions that run in Python workers must load, and run, where the package is not installed."""

import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from medallion.llm import decontaminate, jaccard, lm, neardup, quality, rules, toxicity, vectorcodes, warc
from medallion.llm.text import script_bounds

LOAD = "import pickle, sys; f = pickle.load(sys.stdin.buffer); assert callable(f); print('medallion' in sys.modules)"
RUN = "import pickle, sys; f, a = pickle.load(sys.stdin.buffer); list(f(*a)); print('medallion' in sys.modules)"


def _bare(code, thing, folder):
    done = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(thing), capture_output=True, cwd=folder)
    assert done.returncode == 0, done.stderr.decode()[-600:]
    return done.stdout.strip()


def _worker_functions():
    for module in (decontaminate, jaccard, lm, neardup, quality, rules, toxicity, vectorcodes, warc):
        for name, thing in vars(module).items():
            if callable(thing) and getattr(thing, "__module__", "") == module.__name__ and not isinstance(thing, type):
                yield pytest.param(thing, id=f"{module.__name__.rpartition('.')[2]}.{name}")


@pytest.mark.parametrize("function", list(_worker_functions()))
def test_loads_without_the_package(function, tmp_path):
    assert _bare(LOAD, function, tmp_path) == b"False"


def test_runs_without_the_package(tmp_path):
    texts = pa.RecordBatch.from_pydict({"id": pa.array([1]), "stratum": pa.array(["en"]), "text": pa.array(["a b é 漢"])})
    data = np.frombuffer("é 漢字 a".encode(), np.uint8)
    vectors = pa.RecordBatch.from_pydict({"vector": pa.array([[0.5] * 8])})
    assert _bare(RUN, (script_bounds, (data, np.array([0, len(data)]))), tmp_path) == b"False"
    assert _bare(RUN, (rules._statistics, ([texts],)), tmp_path) == b"False"
    assert _bare(RUN, (vectorcodes._sums([[[1]]] * 8, 8), ([vectors],)), tmp_path) == b"False"
