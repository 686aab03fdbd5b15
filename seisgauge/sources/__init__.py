"""Reading and writing: interchange CSV, text records and the versioned model store."""
