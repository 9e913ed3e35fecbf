import sys

from jobloom.plans.jobs import main

sys.exit(main())
