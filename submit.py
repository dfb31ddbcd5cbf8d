"""spark-submit entry point: ``spark-submit --py-files skirmish.zip submit.py <stream|graph|marts> ...``.

Locally ``python -m skirmish ...`` does the same.
"""

from skirmish.__main__ import main

if __name__ == "__main__":
    main()
