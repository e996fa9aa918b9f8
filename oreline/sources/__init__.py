"""Reading and writing of files, tables and test inputs."""
