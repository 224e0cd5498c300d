"""Entry script: ``spark-submit --py-files tripfold.zip submit.py demand --trips … --output …``."""

from tripfold.jobs import main

if __name__ == "__main__":
    main()
