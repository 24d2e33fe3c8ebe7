"""Entry for spark-submit; see ``python run.py --help``."""

from skyledger.__main__ import main

main()
