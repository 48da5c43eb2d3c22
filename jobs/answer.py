"""Entry script: spark-submit --py-files tillmetrics.zip jobs/answer.py INPUT OUTPUT [options]"""

from tillmetrics.__main__ import main

if __name__ == "__main__":
    main()
