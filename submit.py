"""For spark-submit: ``spark-submit submit.py --help``."""

from rowtide.plans.jobs import main

if __name__ == "__main__":
    main()
