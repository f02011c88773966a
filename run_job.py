"""Entry point for ``spark-submit``; see ``tidewire/jobs.py``."""

from tidewire.jobs import main

if __name__ == "__main__":
    main()
