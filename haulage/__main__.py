import sys

from haulage.cli import main

sys.exit(main())
