"""Entry point for spark-submit: see `tallymark/jobs.py`."""

from tallymark.jobs import main

if __name__ == "__main__":
    main()
