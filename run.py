"""Script form of ``python -m haulage``, for ``spark-submit``."""

import sys

from haulage.cli import main

if __name__ == "__main__":
    sys.exit(main())
