import sys

from ridelens.jobs import main

sys.exit(main())
