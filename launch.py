"""For ``spark-submit``, which takes a file: ``spark-submit ... --py-files trolley.zip launch.py JOB``."""

from trolley.__main__ import main

if __name__ == "__main__":
    main()
