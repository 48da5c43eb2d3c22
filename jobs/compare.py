"""Entry script: spark-submit --py-files tillmetrics.zip jobs/compare.py OUTPUT --clients a,b"""

import sys

from tillmetrics.compare import main

if __name__ == "__main__":
    sys.exit(main())
