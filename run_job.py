"""For spark-submit: ``spark-submit --py-files streambed.zip run_job.py silver --root …``."""

from streambed.plans.jobs import main

if __name__ == "__main__":
    main()
