import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
names = entry.queries()
assert "pay_money_hour" in names and "pipeline" not in names and not any(n.startswith("op1") for n in [*names, *entry.oracle_sql()])
"""


def test_the_text_part_may_be_missing():
    """Without a package of the text operators the other queries are there."""
    for missing in ("public_tokenizers", "gamepulse.llm", "corpus_pipeline"):
        subprocess.run([sys.executable, "-c", CODE.format(missing=missing)], check=True, cwd=Path(__file__).resolve().parents[1])
