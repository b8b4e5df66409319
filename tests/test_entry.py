"""The driver's file, with and without the parts that can be taken out."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), sum(n.startswith('op') or n == 'pipeline' for n in q))"


def counted(block="pass"):
    """How many queries load, and how many of them are of the training-data part."""
    code = f"import sys; sys.path.insert(0, {str(ROOT)!r}); {block}; {COUNT}"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return [int(x) for x in done.stdout.split()], done.stderr


def test_queries_load_without_the_training_data_part():
    whole, _ = counted()
    for missing in ("skeindex.llm", "corpus_pipeline", "xxhash"):
        rest, said = counted(f"sys.modules[{missing!r}] = None")
        assert rest == [whole[0] - whole[1], 0] and "left out" in said
