"""Formats that are claimed but need a package to be read: pdf, docx, xlsx, pptx, images.

None of their readers is built in.  A reader of one's own is registered under the
same name (:func:`.extract.register`, with ``binary=True`` it is given the bytes);
until then a document of such a format is stored, and skipped as one whose
dependency is missing.
"""

from __future__ import annotations

# Package that a reader of each format would use, and how to install it.
REQUIREMENTS = {
    "pdf": ("pypdf", "pip install pypdf"),
    "docx": ("docx", "pip install python-docx"),
    "xlsx": ("openpyxl", "pip install openpyxl"),
    "pptx": ("pptx", "pip install python-pptx"),
    "image-ocr": ("pytesseract", "pip install pytesseract Pillow, and the tesseract program"),
}
