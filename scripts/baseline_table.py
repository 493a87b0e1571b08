
import json
import sys


def main() -> None:
    b = json.loads(open(sys.argv[1]).read())
    print(f"sf={b['sf']}, local[{b['cpus']}], Spark {b['spark']}, runs={b['runs']}, "
          f"warm-up on {b.get('warmup_dir', 'none')} ({b.get('warmup_sec', 0)} s, not counted); "
          f"total {b['value']} s over {len(b['queries'])} queries.\n")
    print("| query | seconds |")
    print("| --- | --- |")
    for k, v in b["queries"].items():
        print(f"| {k} | {v} |")


if __name__ == "__main__":
    main()
