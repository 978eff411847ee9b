"""spark-submit entry point for the snapshot jobs.

    zip -r snapweave.zip snapweave
    spark-submit --py-files snapweave.zip snapweave_submit.py merge /in/a,/in/b /out/merged

Arguments are those of :mod:`snapweave.cli`.
"""

import sys

from snapweave.cli import main

if __name__ == "__main__":
    sys.exit(main())
