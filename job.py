"""spark-submit entry point; see ``rankspark.plans.batch`` for the options."""

from rankspark.plans.batch import main

if __name__ == "__main__":
    main()
