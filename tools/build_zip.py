"""Pack the ``strata`` package into a zip for ``spark-submit --py-files``.

usage: python tools/build_zip.py [out.zip]   (default: dist/strata.zip)
"""

import os
import sys
import zipfile


def main() -> None:
    out = sys.argv[1] if len(sys.argv) > 1 else os.path.join("dist", "strata.zip")
    os.makedirs(os.path.dirname(out) or ".", exist_ok=True)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk("strata"):
            for f in sorted(files):
                if f.endswith(".py"):
                    z.write(os.path.join(root, f))
    print(out)


if __name__ == "__main__":
    main()
