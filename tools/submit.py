"""Driver file for spark-submit: ``spark-submit --py-files tripmart.zip tools/submit.py <command> ...``."""

from tripmart.__main__ import main

main()
