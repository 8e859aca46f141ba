import subprocess
import sys

import pytest

BLOCKED = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
from touchline.plans.registry import ORACLES, QUERIES
assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLES), sorted(entry.queries())
"""


@pytest.mark.parametrize("name", ["touchline.llm", "corpus_pipeline", "xxhash", "public_tokenizers"])
def test_other_queries_stay_without_the_subpackage_or_its_libraries(name):
    done = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
