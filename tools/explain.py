"""Print the formatted physical plan of registered queries: python tools/explain.py [sf_dir] name ..."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratum.proxies.registry import load_all  # noqa: E402
from stratum.session import build_session  # noqa: E402

if __name__ == "__main__":
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    q, _ = load_all()
    spark = build_session("local[8]", 16)
    for name in args:
        print("=" * 20, name)
        q[name](spark, sf).explain("formatted")
