"""Script for ``spark-submit``; same as ``python -m larder``."""

from larder.__main__ import main

if __name__ == "__main__":
    main()
