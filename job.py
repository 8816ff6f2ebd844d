"""Entry point for spark-submit; see ``pressflow.plans.jobs``."""

from pressflow.plans.jobs import main

if __name__ == "__main__":
    main()
