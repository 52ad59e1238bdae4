"""Print the formatted physical plan of a registered query: python tools/explain.py <name> [sf_dir]."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodgelake.queries import queries  # noqa: E402
from lodgelake.session import local_session  # noqa: E402

if __name__ == "__main__":
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    queries()[name](local_session(), sf_dir).explain("formatted")
