"""Entry script for ``spark-submit``."""

from gableframe.plans.cli import main

if __name__ == "__main__":
    main()
